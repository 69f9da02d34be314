"""Versions of splits: readers see one of them, whole, wherever a writer stops."""

import pytest
from pyspark.sql import functions as F

from fieldledger.plans import dataset
from fieldledger.sources import published, readers, writers
from test_jobs import config, inputs  # noqa: F401


def lines(spark, tag, n=200, splits=("train", "val", "test")):
    rows = [(f'{{"instruction": "{tag}", "output": "{i}"}}', splits[i % len(splits)]) for i in range(n)]
    return spark.createDataFrame(rows, "value string, split string").repartition(4)


def seen(spark, path):
    """Which tags the lines of each split have, and how many lines there are."""
    found, _ = readers.scan_text_lines(spark, path)
    read = {s: [r.value.split('"')[3] for r in df.collect()] for s, df in found.items()}
    return {s: set(tags) for s, tags in read.items()}, sum(map(len, read.values()))


def test_next_version_takes_the_place_of_the_last(spark, tmp_path):
    path = str(tmp_path / "out")
    for number, (tag, n) in enumerate([("a", 200), ("b", 30), ("c", 90)], 1):
        version = writers.sink_jsonl_splits(lines(spark, tag, n), path)
        assert version.number == number and published.published_version(spark, path) == version
        assert seen(spark, path) == ({s: {tag} for s in ("train", "val", "test")}, n)
    assert sorted(p.name[:7] for p in (tmp_path / "out").glob("v0*")) == ["v000002", "v000003"]


def test_writer_that_fails_between_two_splits(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.sink_jsonl_splits(lines(spark, "old"), path)
    stop = F.when(F.col("split") == "val", F.raise_error(F.lit("stopped")).cast("string")).otherwise(F.col("value"))
    new = lines(spark, "new").repartition(3, "split").withColumn("value", stop)
    with pytest.raises(Exception, match="stopped"):
        writers.sink_jsonl_splits(new, path)
    assert seen(spark, path) == ({s: {"old"} for s in ("train", "val", "test")}, 200)
    writers.sink_jsonl_splits(lines(spark, "newer", 12), path)
    assert seen(spark, path) == ({s: {"newer"} for s in ("train", "val", "test")}, 12)


def test_writer_that_stops_before_the_manifest(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    writers.sink_jsonl_splits(lines(spark, "old"), path)

    def stopped(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(writers, "publish", stopped)
        with pytest.raises(KeyboardInterrupt):
            writers.sink_jsonl_splits(lines(spark, "new"), path)
    assert len(list((tmp_path / "out").glob("v0*"))) == 2
    assert seen(spark, path) == ({s: {"old"} for s in ("train", "val", "test")}, 200)
    writers.sink_jsonl_splits(lines(spark, "a", 9), path, keep=0)
    writers.sink_jsonl_splits(lines(spark, "b", 9), path, keep=0)
    assert [p.name[:7] for p in (tmp_path / "out").glob("v0*")] == ["v000003"]


def test_reader_of_a_version_keeps_it(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.sink_jsonl_splits(lines(spark, "old"), path)
    found, _ = readers.scan_text_lines(spark, path)
    writers.sink_jsonl_splits(lines(spark, "new"), path)
    assert all("old" in r.value for df in found.values() for r in df.collect())


def test_empty_and_missing_splits(spark, tmp_path):
    path = str(tmp_path / "out")
    assert published.published_version(spark, path) is None
    writers.sink_jsonl_splits(lines(spark, "a", 5, ["train"]), path)
    found, report = readers.scan_text_lines(spark, path, ["train", "val", "other"])
    assert {s: df.count() for s, df in found.items()} == {"train": 5, "val": 0}
    assert {r.split: r.readable for r in report.collect()} == {"train": True, "val": True, "other": False}
    with pytest.raises(FileNotFoundError):
        readers.scan_split_records(spark, path, "other")
    plain = tmp_path / "plain" / "train.jsonl"
    plain.mkdir(parents=True)
    (plain / "part-0").write_text('{"instruction": "a", "output": "b"}\n', "utf-8")
    assert readers.scan_split_records(spark, str(tmp_path / "plain"), "train").count() == 1


def test_build_reads_the_incidents_once(spark, inputs, tmp_path, monkeypatch):  # noqa: F811
    source = tmp_path / "incidents.csv"
    source.write_bytes((inputs / "incidents.csv").read_bytes())
    given, staged = config(tmp_path, tmp_path / "out", max_records=150), dataset.staged
    given = dataset.DatasetConfig(**{**vars(given), "log_paths": [f"{inputs}/log/{y}*.csv" for y in (2015, 2016, 2017)]})

    def gone_afterwards(df, name, *more):
        table = staged(df, name, *more)
        if name == "incidents":
            source.unlink()
        return table

    monkeypatch.setattr(dataset, "staged", gone_afterwards)
    report = dataset.build_dataset(spark, given)
    stages = {r.stage: r.n_rows for r in report.stages.collect()}
    assert (stages["raw"], stages["cleaned"], stages["sampled"], stages["rendered"]) == (400, 200, 150, 150)
    assert sum(r.n_records for r in report.readback.collect()) == 150
