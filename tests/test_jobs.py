"""The jobs from files to files."""

import json
import subprocess
import sys
from pathlib import Path

import pytest

from fieldledger.operators.quality import EmptyStageError, MissingColumnsError
from pyspark.sql import functions as F

from fieldledger.checks import proxies
from fieldledger.plans.chat_texts import compare_responses, prepare_chat_texts, prepare_conversations, sift_records
from fieldledger.plans.dataset import DatasetConfig, build_dataset
from fieldledger.plans.describe import describe_dataset
from fieldledger.operators.records import rejected_lines
from fieldledger.scratch import scratch_root
from fieldledger.sources import readers
from fieldledger.sources.published import split_lines

HEADER = "eventid,iyear,country_txt,attacktype1_txt,targtype1_txt,weaptype1_txt,nkill,nwound,gname\n"


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    base = tmp_path_factory.mktemp("inputs")
    rows = [f"{i},{2014 + i % 4},{['Yemen', 'Iraq', 'Peru'][i % 3]},{['Bombing', 'Unknown', 'Armed Assault', ''][i % 4]},,Bomb,{i % 12},{i % 3},G{i}\n" for i in range(400)]
    (base / "incidents.csv").write_text(HEADER + "".join(rows), "utf-8")
    (base / "log").mkdir()
    for year in (2014, 2015, 2016, 2017):
        lines = []
        for i in range(300):
            fields = [""] * 57
            fields[0], fields[1], fields[7] = str(i), f"{year}0101", ["YEM", "irq", "ZZZ", "", "YE"][i % 5]
            lines.append("\t".join(fields))
        (base / "log" / f"{year}0101.export.csv").write_text("\n".join(lines) + "\n", "utf-8")
    return base


def config(inputs, out, **more):
    logs = [f"{inputs}/log/{year}*.csv" for year in (2015, 2016, 2017)]
    return DatasetConfig(f"{inputs}/incidents.csv", logs, str(out), **more)


def read_lines(out):
    last = max(Path(out).glob("v0*"))
    return {
        split: [json.loads(s) for f in Path(last, f"split={split}").glob("part-*") for s in f.read_text("utf-8").splitlines()]
        for split in ("train", "val", "test")
    }


def test_build_describe_chat(spark, inputs, tmp_path):
    out = tmp_path / "out"
    report = build_dataset(spark, config(inputs, out, files_per_split=1))
    lines = read_lines(out)
    assert sum(map(len, lines.values())) == 200
    records = [r for rs in lines.values() for r in rs]
    assert all(list(r) == ["system", "instruction", "input", "output"] and r["input"] == "" for r in records)
    # 60 log rows per year and code; 2014 has no log, Peru is not in it.
    active = [r for r in records if "holds 60 events" in r["output"]]
    expected = sum(1 for i in range(400) if i % 4 in (0, 2) and i % 4 != 0 and i % 3 != 2)
    assert len(active) == expected
    rate = report.match_rate.first()
    assert (rate.n_matched, rate.n_rows, rate.match_pct) == (expected, 200, 100 * expected // 200)
    stages = {r.stage: r.n_rows for r in report.stages.collect()}
    assert {k: n for k, n in stages.items() if n} == {"raw": 400, "cleaned": 200, "sampled": 200, "rendered": 200, "matched": expected, "activity": 6}
    assert [tuple(r) for r in report.log_widths.collect()] == [(57, 900, True)]
    assert spark.read.parquet(f"{out}/_report/stages").count() == len(stages)
    assert not list(out.glob("_writing*"))
    assert {r["column"] for r in report.schema.collect() if not r.present} == {"summary"}
    sizes = {r.split: (r.n_rows, r.estimated) for r in report.split_sizes.collect()}
    assert {s: n for s, (n, _) in sizes.items()} == {s: len(rs) for s, rs in lines.items()}
    assert {s: e for s, (_, e) in sizes.items()} == {"train": 160, "val": 20, "test": 20}
    assert all(r.n_unparsed == 0 and r.n_records == len(lines[r.split]) for r in report.readback.collect())

    tables = describe_dataset(spark, str(out), str(tmp_path / "profile"))
    labels = {r.label: r.n_rows for r in tables["labels"].collect()}
    assert labels == {"Bombing": 100, "Armed Assault": 100}
    summary = tables["summary"].first()
    assert (summary.n_parsed, summary.n_labels, summary.top_label) == (200, 2, "Armed Assault")
    assert sum(r.n_rows for r in tables["histogram"].collect()) == 200
    words = sum(len((r["instruction"] + " " + r["output"]).split()) for r in records) // 200
    assert tables["length_stats"].first().mean_all == words
    assert spark.read.parquet(f"{tmp_path}/profile/labels").count() == 2

    made = prepare_chat_texts(spark, str(out), str(tmp_path / "chat"))
    texts = [json.loads(r.value)["text"] for r in split_lines(spark, str(tmp_path / "chat"), "texts").collect()]
    assert len(texts) == len(lines["train"])
    assert any(lines["train"][0]["output"] + "<|eot_id|>" == t[-len(lines["train"][0]["output"]) - 10 :] for t in texts)
    assert made["terminators"].first().n_doubled == 0
    assert made["schedule"].first().steps_per_epoch == len(texts) / 8
    assert made["records"].first().n_rows == len(texts) and made["rejected"].isEmpty()


def test_bounded_and_random(spark, inputs, tmp_path):
    build_dataset(spark, config(inputs, tmp_path / "a", max_records=50))
    first = read_lines(tmp_path / "a")
    assert sum(map(len, first.values())) == 50
    build_dataset(spark, config(inputs, tmp_path / "b", max_records=50, random=True))
    second = read_lines(tmp_path / "b")
    key = lambda lines: sorted(r["output"] for rs in lines.values() for r in rs)
    assert key(first) == key(second)


def test_empty_and_wrong_inputs_stop_the_job(spark, inputs, tmp_path):
    with pytest.raises(EmptyStageError):
        build_dataset(spark, config(inputs, tmp_path / "c", names={"XXX": "Nowhere"}))
    (tmp_path / "narrow.csv").write_text("a\tb\n", "utf-8")
    narrow = DatasetConfig(f"{inputs}/incidents.csv", [str(tmp_path / "narrow.csv")], str(tmp_path / "d"))
    with pytest.raises(MissingColumnsError):
        build_dataset(spark, narrow)
    with pytest.raises(EmptyStageError):
        describe_dataset(spark, str(tmp_path / "absent"))


def test_describe_skips_a_missing_split(spark, tmp_path):
    (tmp_path / "train.jsonl").mkdir()
    (tmp_path / "train.jsonl" / "part-0").write_text('{"instruction": "a", "output": "X — B | c"}\njunk\n', "utf-8")
    tables = describe_dataset(spark, str(tmp_path))
    assert {r.split: r.readable for r in tables["readable"].collect()} == {"train": True, "val": False, "test": False}
    summary = tables["summary"].first()
    assert (summary.n_parsed, summary.n_train, summary.top_label, summary.top_count) == (1, 2, "B", 1)


def test_command_line_names_its_jobs():
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-m", "fieldledger", "--help"], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and "describe" in done.stdout


def test_nothing_is_cut_by_default():
    assert DatasetConfig("a", ["b"], "c").max_records == 0


def test_build_leaves_no_staged_tables(spark, inputs, tmp_path):
    root = Path(scratch_root(spark))
    before = {p.name for p in root.iterdir()}
    build_dataset(spark, config(inputs, tmp_path / "out"))
    assert {p.name for p in root.iterdir()} == before


def test_conversations_and_comparison(spark, tmp_path):
    talks = [{"conv_id": 1, "turn": t, "role": r, "text": x} for t, r, x in ((0, "system", "s"), (1, "user", "q"), (2, "assistant", "a"), (3, "user", None))]
    (tmp_path / "talks.jsonl").write_text("\n".join(map(json.dumps, talks)), "utf-8")
    made = prepare_conversations(spark, str(tmp_path / "talks.jsonl"), str(tmp_path / "out"))
    assert tuple(made["messages"].first()) == (4, 1) and tuple(made["pairs"].first()) == (1, 0)
    assert spark.read.json(f"{tmp_path}/out/texts").first().n_turns == 4
    assert tuple(made["prompts"].first()) == (1, 1)
    prompt = spark.read.json(f"{tmp_path}/out/prompts").first()
    assert prompt.messages_text.index("\n\ns<") < prompt.messages_text.index("\n\nq<") and prompt.response == "a"
    for name, ids in (("base", "pq"), ("tuned", "qr")):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps({"prompt_id": i, "response": "x y"}) for i in ids), "utf-8")
    done = compare_responses(spark, str(tmp_path / "base.jsonl"), str(tmp_path / "tuned.jsonl"), str(tmp_path / "versus"))
    assert {r.answered_by: r.n_prompts for r in done["prompts"].collect()} == {"base": 1, "tuned": 1, "both": 1}
    assert {r.label: r.n_rows for r in done["layout"].collect()} == {"base": 2, "tuned": 2}
    assert {r.answered_by: r.n_rows for r in done["responses"].collect()} == {"base": 1, "tuned": 1, "both": 1}


def test_chat_and_report_agree_on_usable_lines(spark, folder, tmp_path):
    lines = proxies.damaged_lines(spark, folder).select(F.translate("value", "\n", " ").alias("value"))
    lines.write.text(f"{tmp_path}/train.jsonl")
    made = prepare_chat_texts(spark, str(tmp_path), str(tmp_path / "chat"))
    n_texts = made["records"].first().n_rows
    thrown = {r.kind: r.n_rows for r in made["rejected"].collect()}
    kinds = {r.kind: r.n_rows for r in describe_dataset(spark, str(tmp_path))["kinds"].collect()}
    assert n_texts == kinds["ok"] + kinds["no_label"] == split_lines(spark, str(tmp_path / "chat"), "texts").count()
    assert thrown == {k: n for k, n in kinds.items() if k not in ("ok", "no_label")} and len(kinds) == 5
    rejected = rejected_lines(split_lines(spark, str(tmp_path / "chat"), "rejected")).collect()
    given = {r.value for r in lines.collect()}
    assert all(r.value in given and r.file_name.startswith("part-") and r.block_start == 0 for r in rejected)
    assert len({(r.file_name, r.row) for r in rejected}) == len(rejected) == sum(thrown.values())


def test_sift_loses_no_line(spark, tmp_path):
    good, bad = '{"instruction": "a", "output": "é \\u0000"}', ["junk", "[1]", '{"instruction": 1, "output": ""}', "", '{"a": 1} x']
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([good] * 300 + bad) + "\n", "utf-8")
    (tmp_path / "in" / "b.txt").write_text("\n".join([bad[0], good, bad[0]]) + "\n", "utf-8")
    made = sift_records(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    kinds = {r.kind: r.n_rows for r in made["rejected"].collect()}
    assert made["records"].first().n_rows == 301 and sum(kinds.values()) == 7
    assert kinds == {"not_json": 5, "not_object": 1, "not_text": 1}
    rejected = rejected_lines(split_lines(spark, str(tmp_path / "out"), "rejected")).collect()
    assert sorted(r.value for r in rejected) == sorted([*bad, bad[0], bad[0]])
    assert sorted((r.file_name, r.row) for r in rejected if r.file_name == "b.txt" or r.value == "[1]")[0] == ("a.txt", 301)
    again = readers.scan_split_records(spark, str(tmp_path / "out"), "records")
    assert again.where(F.col(readers.CORRUPT).isNotNull()).isEmpty() and again.count() == 301
    none = sift_records(spark, str(tmp_path / "out" / "v000001*" / "split=records"), str(tmp_path / "clean"))
    assert none["records"].first().n_rows == 301 and none["rejected"].isEmpty()
