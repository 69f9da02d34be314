"""Text functions against Python's own on random strings, and the scratch folder."""

import json
import random

import pytest
from pyspark.sql import functions as F

from fieldledger import scratch
from fieldledger.functions import casts, records, text

ALPHABET = list("abzABZ09éÉßñ日本😀-'/()|.,—\\\"") + ["— ", " |", "\n"] + list(" \t\r\x0b\x0c\x1c\x1f\x85\xa0   　​\x7f\x01")


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(25))) for _ in range(n)]


@pytest.fixture(scope="module")
def given(spark):
    values = texts(3000, 11)
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").repartition(8)
    return values, frame


def python_label(output):
    line = output.split("\n")[0].split("— ", 1)
    return line[1].split(" |")[0].strip().title() if len(line) > 1 else None


CASES = {
    "word_count": (lambda c: text.word_count(c), lambda s: len(s.split())),
    "strip": (lambda c: casts.strip(c), str.strip),
    "nonblank": (lambda c: text.nonblank(c), lambda s: bool(s.strip())),
    "label": (lambda c: text.label_of(c), python_label),
}


@pytest.mark.parametrize("name", list(CASES))
def test_like_python(given, name):
    values, frame = given
    expression, python = CASES[name]
    got = dict(frame.select("i", expression(F.col("v"))).collect())
    wrong = [(v, got[i], python(v)) for i, v in enumerate(values) if got[i] != python(v)]
    assert wrong == []


@pytest.mark.parametrize("encode", [records.encode_record, records.encode_record_spaced])
def test_records_round_trip(given, encode):
    values, frame = given
    lines = frame.select("i", encode(F.lit("s"), F.col("v"), F.col("v")).alias("value"))
    assert all(json.loads(r.value)["output"] == values[r.i] for r in lines.collect())
    parsed, record = records.decoded(lines)
    assert all(r.t == values[r.i] for r in parsed.select("i", record.text("instruction").alias("t")).collect())


def test_damaged_records_like_python(spark, given):
    values, _ = given
    rng = random.Random(5)
    lines = []
    for v in values:
        line = json.dumps({"instruction": v, "output": rng.choice([v, 1, None, [v]])}, ensure_ascii=rng.random() < 0.5)
        cut = rng.randrange(len(line))
        lines.append(rng.choice([line, line[:cut], line[:cut] + line[cut + 1 :], line + rng.choice("]} x\n")]))
    frame = spark.createDataFrame(list(enumerate(lines)), "i int, value string").repartition(8)

    def python(line, key):
        try:
            found = json.loads(line).get(key, "")
        except Exception:
            return None
        if not isinstance(found, str):
            return None
        # Half of a surrogate pair has no UTF-8 form; Spark keeps a question mark for it.
        return found.encode("utf-8", "replace").decode("utf-8")

    parsed, record = records.decoded(frame)
    got = {r.i: (r.a, r.b) for r in parsed.select("i", record.text("instruction").alias("a"), record.text("output").alias("b")).collect()}
    wrong = [
        (line, got[i]) for i, line in enumerate(lines) if got[i] != (python(line, "instruction"), python(line, "output"))
    ]
    assert wrong == []


class Session:
    def __init__(self, **settings):
        self.conf = self
        self._settings = settings

    def get(self, name, default=None):
        return self._settings.get(name.replace(".", "_"), default)


def test_scratch_folder_is_the_sessions():
    assert scratch.scratch_root(Session(spark_checkpoint_dir="hdfs://shared/ck/")) == "hdfs://shared/ck"
    with pytest.raises(ValueError):
        scratch.scratch_root(Session(spark_master="yarn"))
    own = scratch.scratch_root(Session(spark_master="local[2]"))
    assert own == scratch.scratch_root(Session(spark_master="local[2]"))
