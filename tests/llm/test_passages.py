import random
import zlib

import numpy as np
import plain
from fieldledger.llm import passages
from fieldledger.llm.passages import BUCKETS, WORDS, Attention, encode, fit, quality_by_passages, training_sample
from fieldledger.llm.queries import QUERIES
from pyspark.sql import functions as F

KEYS = ["lower", "upper", "digit", "space", "stop", "sign", "wide"]


def kind(b):
    c = chr(b)
    if b >= 128:
        return "wide"
    if c.isspace() and (b == 32 or 9 <= b <= 13):
        return "space"
    return "stop" if c in ".,;:" else "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "sign"


def plain_passages(text):
    """Shape figures of each passage: shares of kinds, words, words seen before."""
    raw = text.encode()
    words, at = [], 0
    for w in raw.split():
        at = raw.index(w, at)
        words.append((at, w))
        at += len(w)
    out = []
    for i in range(0, len(words), WORDS):
        mine = words[i : i + WORDS]
        stop = words[i + WORDS][0] if i + WORDS < len(words) else len(raw) + 1
        part = (raw + b"\n")[mine[0][0] : stop]
        kinds = [kind(b) for b in part]
        shares = [kinds.count(k) / len(part) for k in KEYS]
        sizes = np.array([len(w) for _, w in mine])
        seen = {w for _, w in words[:i]}
        inner = len(mine) - len({w for _, w in mine})
        outer = len(mine) - len({w for _, w in mine} - seen)
        n = len(mine)
        more = [sizes.mean() / 10, sizes.std() / 10, part.count(b"\n") / n, sum(kind(w[-1]) == "sign" for _, w in mine) / n]
        more += [(sizes == 1).sum() / n, inner / n, outer / n, np.log(len(part)) / 10, n / WORDS]
        out.append(shares + more)
    return out


def test_passages_cover_whole_texts():
    rng = random.Random(2)
    texts = ["", " \n", "a", "é😀 a! a", "x " * 64, "x " * 65, "\n a  b\t c#\n", "1,2;3 " * 100]
    texts += [plain.syllables(rng, rng.randint(1, 400)).replace(" ", rng.choice([" ", "  ", "\n"])) for _ in range(30)]
    features, first = encode([t.encode() for t in texts])
    for t, a, b in zip(texts, first[:-1], first[1:], strict=True):
        want = plain_passages(t) or [[0.0] * 16]
        assert b - a == len(want)
        assert np.allclose(features[a:b, BUCKETS:], want, atol=1e-5), t
        grams = (features[a:b, :BUCKETS] ** 2).sum(axis=1)
        assert np.allclose(grams, 1 if t.split() else 0, atol=1e-4)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    x, first = rng.standard_normal((11, 5)), np.array([0, 1, 4, 11])
    label = np.array([1.0, 0.0, 1.0])
    model = Attention.new(x)
    model.p = {k: v.astype(np.float64) + rng.standard_normal(v.shape) * 0.3 for k, v in model.p.items()}

    def loss():
        s = model._forward(x, first)[-1]
        return -np.mean(label * np.log(s) + (1 - label) * np.log(1 - s))

    found = model.gradients(x, first, label)
    for k, v in model.p.items():
        for at in list(np.ndindex(v.shape))[:20]:
            kept, step = v[at], 1e-5
            v[at] = kept + step
            up = loss()
            v[at] = kept - step
            down = loss()
            v[at] = kept
            assert abs((up - down) / (2 * step) - found[k][at]) < 1e-6, (k, at)


def test_attention_finds_the_passage_that_tells():
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 9, 600)
    first = np.concatenate(([0], np.cumsum(sizes)))
    x = rng.standard_normal((first[-1], 6)).astype(np.float32)
    label = rng.integers(0, 2, 600)
    where = first[:-1] + rng.integers(0, sizes)
    x[where, 0] = np.where(label == 1, 6, -6)
    model = fit(x, first, label)
    score, attention = model.score(x, first)
    assert ((score > 0.5) == label).mean() > 0.97
    wide = np.flatnonzero(sizes > 2)
    assert np.mean([attention[first[i] : first[i + 1]].argmax() == where[i] - first[i] for i in wide]) > 0.9


def test_query_on_held_out_labels(spark, folder):
    found = QUERIES["op12_passage_quality"](spark, folder)
    assert dict(found.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = found.collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    right = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        if r.held_out and r.doc_id in labels:
            right.append(r.predicted == labels[r.doc_id])
    assert np.mean(right) > 0.85


def test_held_out_labels_and_other_columns_do_not_matter(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(passages.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit(None).cast("string")).withColumn("label", F.lit(1))
    one = {r.doc_id: r.score for r in quality_by_passages(docs, labels).collect()}
    two = {r.doc_id: r.score for r in quality_by_passages(other, flipped).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-6 for k in one)


def test_bounds_of_the_sample(spark):
    rows = [(i, f"w{i} " * (1 + i % 7 * 40), "en") for i in range(300)] + [(i, "same", "en") for i in range(1000, 1200)]
    labels = spark.createDataFrame([(i, i % 2) for i, *_ in rows] + [(None, 1), (3, None)], "doc_id long, quality int")
    docs = plain.table(spark, rows)
    features, first, label = training_sample(docs, labels, "doc_id", "text", "quality", 50, 60)
    assert 10 < len(label) <= 50 and 10 < len(features) <= 60 and first[-1] == len(features)
    features, first, label = training_sample(docs, labels, "doc_id", "text", "quality")
    free = [i for i, *_ in rows[:300] if zlib.crc32(str(i).encode()) % 4 != 2]
    assert len(label) == len(free) + 1 and ((0 < label) & (label < 1)).sum() == 1


def test_odd_rows(spark):
    rows = [*plain.odd_rows(random.Random(5)), (40, "a " * 100_000, "en")]
    labels = spark.createDataFrame([(r[0], (r[0] or 0) % 2) for r in rows], "doc_id long, quality int")
    docs = plain.table(spark, rows)
    found = quality_by_passages(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert {r.n_passages for r in found if r.doc_id in (1, 2, 3)} == {1}
    assert [r.n_passages for r in found if r.doc_id == 40] == [-(-100_000 // WORDS)]
    assert {r.score for r in quality_by_passages(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_by_passages(plain.table(spark, []), labels).count() == 0
