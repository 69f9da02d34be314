"""Quality of documents by attention over their passages.

A document is a bag of passages of `WORDS` words, and only the document is labelled.
Every passage is encoded: hashed byte trigrams and figures of its shape go through one
layer. A gated attention layer weighs the passages, the weighted sum stands for the
document, and a logistic unit scores it. All weights are learned together from the
labels of documents, on a bounded sample; every document is scored, with all passages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldledger.llm.common import slices, text_or_empty
from fieldledger.llm.registry import query, reach, table
from fieldledger.llm.words import _BACK, _STEP, _power, mixed
from fieldledger.scratch import staged

#: Words of a passage; buckets of its trigrams; figures of its shape.
WORDS, BUCKETS, SHAPES = 64, 256, 16

#: Bounds of the sample that the weights are fitted on: documents with different texts,
#: and passages of them in all. Nothing else is bounded.
TRAINING_ROWS, TRAINING_PASSAGES = 3_000, 60_000

#: Units of the passage layer and of the attention layer.
UNITS, GATES = 32, 16

EPOCHS, BATCH, RATE, DECAY = 25, 64, 0.004, 1e-4

#: Least score of a document that counts as good.
GOOD = 0.7

#: A held-out document has this remainder.
PARTS, HELD_OUT = 4, 2

_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _SIGN, _WIDE = range(7)


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, _SIGN)
    kinds[128:] = _WIDE
    for low, high, kind in ((97, 122, _LOWER), (65, 90, _UPPER), (48, 57, _DIGIT), (9, 13, _SPACE)):
        kinds[low : high + 1] = kind
    kinds[32] = _SPACE
    kinds[list(b".,;:")] = _STOP
    return kinds


_KIND = _byte_classes()


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, first): a row per passage, and each text's first row, with one more.

    A text without words has one passage, of zeros.
    """
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    kind = _KIND[raw]
    inside = kind != _SPACE
    begin = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    stop = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False]))) + 1
    doc = np.searchsorted(ends, begin, side="right")
    words = np.bincount(doc, minlength=len(texts))
    many = np.maximum(1, -(-words // WORDS))
    first = np.concatenate(([0], np.cumsum(many)))
    turn = np.arange(len(begin)) - (np.cumsum(words) - words)[doc]
    passage = first[doc] + turn // WORDS
    rows = int(first[-1])
    out = np.zeros((rows, BUCKETS + SHAPES), np.float32)
    if not len(begin):
        return out, first
    lead = np.flatnonzero(np.diff(passage, prepend=-1))  # the first word of each passage
    upto = np.append(begin[lead[1:]], len(raw))
    upto = np.minimum(upto, ends[doc[lead]])  # up to the next passage or the text's end
    sizes = upto - begin[lead]
    at = np.arange(int(sizes.sum())) + np.repeat(begin[lead] - (np.cumsum(sizes) - sizes), sizes)
    whose = np.repeat(passage[lead], sizes)
    padded = np.concatenate((raw, np.full(2, 10, np.uint8))).astype(np.uint32)
    three = (padded[:-2] << 16) | (padded[1:-1] << 8) | padded[2:]
    bucket = ((three * np.uint32(2654435761)) >> np.uint32(24)).astype(np.int64)
    grams = np.bincount(whose * BUCKETS + bucket[at], minlength=rows * BUCKETS)
    out[:, :BUCKETS] = np.sqrt(grams.reshape(rows, BUCKETS) / np.bincount(whose, minlength=rows).clip(1)[:, None])
    out[:, BUCKETS:] = _shapes(raw, kind, at, whose, begin, stop, passage, doc, rows)
    return out, first


def _shapes(raw, kind, at, whose, begin, stop, passage, doc, rows) -> np.ndarray:
    """Shares of kinds of bytes, lengths of words and lines, and words that come again."""
    total = np.bincount(whose, minlength=rows).clip(1)
    shares = np.bincount(whose * 7 + kind[at], minlength=rows * 7).reshape(rows, 7) / total[:, None]
    count = np.bincount(passage, minlength=rows)
    n = count.clip(1)
    length = (stop - begin).astype(np.float64)
    mean = np.bincount(passage, length, rows) / n
    spread = np.sqrt(np.maximum(0, np.bincount(passage, length**2, rows) / n - mean**2))
    lines = np.bincount(whose, raw[at] == 10, rows) / n
    ends = np.bincount(passage, kind[stop - 1] == _SIGN, rows) / n
    alone = np.bincount(passage, length == 1, rows) / n
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(mixed(raw + np.uint64(1)) * _power(_STEP, len(raw)), out=sums[1:])
    word = mixed((sums[stop] - sums[begin]) * _power(_BACK, len(raw) + 1)[begin])
    again = np.zeros(len(begin), bool)
    order = np.lexsort((word, passage))
    again[order[1:]] = (np.diff(word[order]) == 0) & (np.diff(passage[order]) == 0)
    inner = np.bincount(passage, again, rows) / n
    after = np.zeros(len(begin), bool)
    order = np.lexsort((word, doc))
    after[order[1:]] = (np.diff(word[order]) == 0) & (np.diff(doc[order]) == 0)
    outer = np.bincount(passage, after, rows) / n
    figures = [mean / 10, spread / 10, lines, ends, alone, inner, outer, np.log(total) / 10, count / WORDS]
    return np.column_stack([shares, *figures]).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Attention:
    """The weights of all layers, and the scale of the features."""

    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, features: np.ndarray, seed: int = 0) -> Attention:
        rng = np.random.default_rng(seed)
        new = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        p = {
            "w": new(features.shape[1], UNITS), "b": np.zeros(UNITS, np.float32),
            "v": new(UNITS, GATES), "u": new(UNITS, GATES), "a": new(GATES, 1)[:, 0],
            "c": new(UNITS, 1)[:, 0], "d": np.zeros(1, np.float32),
        }
        return cls(features.mean(axis=0), features.std(axis=0) + 1e-3, p)

    def _forward(self, x: np.ndarray, first: np.ndarray):
        """Values of all layers for passages `x`, whose documents begin at `first`."""
        p, begin, many = self.p, first[:-1], np.diff(first)
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        e = (t * g) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, begin), many))
        attention = e / np.repeat(np.add.reduceat(e, begin), many)
        z = np.add.reduceat(attention[:, None] * h, begin, axis=0)
        return h, t, g, attention, z, _sigmoid(z @ p["c"] + p["d"])

    def scaled(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.scale, -8, 8)

    def score(self, features: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A score for each document, and the attention on each passage."""
        *_, attention, _, score = self._forward(self.scaled(features), first)
        return score.astype(np.float64), attention.astype(np.float64)

    def gradients(self, x, first, label) -> dict[str, np.ndarray]:
        p, many = self.p, np.diff(first)
        h, t, g, attention, z, score = self._forward(x, first)
        out = (score - label) / len(label)
        dz = np.repeat(out[:, None] * p["c"], many, axis=0)
        da = (dz * h).sum(axis=1)
        de = attention * (da - np.repeat(np.add.reduceat(attention * da, first[:-1]), many))
        gate = de[:, None] * p["a"]
        dt, dg = gate * g * (1 - t * t), gate * t * g * (1 - g)
        dh = attention[:, None] * dz + dt @ p["v"].T + dg @ p["u"].T
        dh *= 1 - h * h
        return {
            "w": x.T @ dh, "b": dh.sum(axis=0), "v": h.T @ dt, "u": h.T @ dg,
            "a": (t * g).T @ de, "c": z.T @ out, "d": out.sum(keepdims=True),
        }


def fit(features: np.ndarray, first: np.ndarray, label: np.ndarray) -> Attention:
    """Weights for documents whose passages are the rows of `features` from `first` on."""
    model = Attention.new(features)
    x, rng, many = model.scaled(features).astype(np.float32), np.random.default_rng(1), np.diff(first)
    label = label.astype(np.float32)
    mean = {k: np.zeros_like(v) for k, v in model.p.items()}
    square, step = {k: np.zeros_like(v) for k, v in model.p.items()}, 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(label))
        rate = RATE * (1 - epoch / EPOCHS)
        for part in np.split(order, range(BATCH, len(order), BATCH)):
            sizes = many[part]
            cuts = np.concatenate(([0], np.cumsum(sizes)))
            rows = np.arange(cuts[-1]) + np.repeat(first[part] - cuts[:-1], sizes)
            step += 1
            for k, slope in model.gradients(x[rows], cuts, label[part]).items():
                mean[k] += 0.1 * (slope - mean[k])
                square[k] += 0.001 * (slope * slope - square[k])
                change = (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
                model.p[k] -= (rate * (change + DECAY * model.p[k])).astype(np.float32)
    return model


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        features, first = encode(batch.column("text").cast(pa.binary()).to_pylist())
        rows = [features[a:b].astype(np.float16) for a, b in zip(first[:-1], first[1:], strict=True)]
        columns = [
            *(batch.column(c) for c in ("hash", "label")),
            pa.array(np.diff(first), pa.int64()),
            pa.array([r.tobytes() for r in rows], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["hash", "label", "n", "features"])


class _Score:
    def __init__(self, model: Attention | None):
        self.model = model

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            many, best, score = np.ones(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64), np.full(batch.num_rows, 0.5)
            if self.model:
                features, first = encode(batch.column("text").cast(pa.binary()).to_pylist())
                score, attention = self.model.score(features, first)
                many = np.diff(first)
                best = [int(attention[a:b].argmax()) for a, b in zip(first[:-1], first[1:], strict=True)]
            columns = [batch.column("doc"), batch.column("out"), pa.array(score), pa.array(many), pa.array(best, pa.int64())]
            names = ["doc_id", "held_out", "score", "n_passages", "top_passage"]
            yield pa.RecordBatch.from_arrays(columns, names)


def held_out(doc: Column) -> Column:
    """Whether labels of a document are kept from training; false for a null id."""
    rest = F.crc32(doc.cast("string").cast("binary")) % PARTS
    return F.coalesce(rest == HELD_OUT, F.lit(False))


def training_sample(
    docs: DataFrame, labels: DataFrame, doc: str, text: str, label: str,
    rows: int = TRAINING_ROWS, passages: int = TRAINING_PASSAGES,
) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(features, first, label) of a sample of labelled documents that are not held out.

    Equal texts are one document, whose label is the mean of theirs. Of the different
    texts, those with the smallest hashes are taken, up to `rows` and, among these, up to
    `passages` passages in all; a document is taken whole or not at all.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc).isNotNull())
    known = known.where(~held_out(F.col(doc))).select(F.col(doc).alias("doc"), F.col(label).cast("double").alias("label"))
    slim = docs.select(F.col(doc).alias("doc"), text_or_empty(text).alias("text"))
    slim = slim.where(F.col("doc").isNotNull()).withColumn("hash", F.xxhash64("text"))
    texts = slim.select("doc", "hash").join(known, "doc").groupBy("hash")
    texts = texts.agg(F.avg("label").alias("label"), F.min("doc").alias("doc"))
    chosen = staged(texts.orderBy("hash").limit(rows), "chosen")
    whole = slim.join(F.broadcast(chosen), ["doc", "hash"]).dropDuplicates(["hash"])
    whole = whole.select("hash", "label", "text")
    encoded = staged(whole.mapInArrow(_encoded, "hash long, label double, n long, features binary"), "features")
    before = Window.orderBy("hash").rowsBetween(Window.unboundedPreceding, 0)
    sizes = encoded.select("hash", "n")  # at most `rows` rows
    fitting = sizes.withColumn("upto", F.sum("n").over(before)).where(F.col("upto") <= passages)
    found = encoded.join(F.broadcast(fitting.select("hash")), "hash")
    taken = found.orderBy("hash").collect()
    if not taken:
        return None
    width = BUCKETS + SHAPES
    features = [np.frombuffer(r.features, np.float16).reshape(-1, width) for r in taken]
    first = np.concatenate(([0], np.cumsum([len(x) for x in features])))
    return np.concatenate(features).astype(np.float32), first, np.array([r.label for r in taken])


def quality_by_passages(
    docs: DataFrame,
    labels: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    **sample,
) -> DataFrame:
    """(doc_id, held_out, score, n_passages, top_passage), one row per document.

    `score`, from 0 to 1, is how likely label 1 is; `top_passage` is the number of the
    passage with the greatest weight, from 0. Weights are fitted on labels of documents that
    are not held out, on at most `rows` documents and `passages` passages (`training_sample`).
    Nothing but the text is looked at for a score.

    A null or empty text, or one without words, is one passage without words and gets
    the score that the model gives to it. Null labels and null ids of labels count for
    nothing; without labelled documents every score is 0.5. Repeated rows are scored each
    for itself; an empty table gives an empty result; other columns are not read. A very
    long text is one slice of its own, with all its passages.
    """
    reach(docs.sparkSession)
    taken = training_sample(docs, labels, doc, text, label, **sample)
    model = fit(*taken) if taken else None
    slim = docs.select(F.col(doc).alias("doc"), held_out(F.col(doc)).alias("out"), text_or_empty(text).alias("text"))
    kind = slim.schema["doc"].dataType.simpleString()
    return slim.mapInArrow(
        _Score(model),
        f"doc_id {kind}, held_out boolean, score double, n_passages long, top_passage long",
    )


@query("op12_passage_quality")
def op12_passage_quality(spark, folder):
    docs, labels = (table(spark, folder, n) for n in ("documents", "labels"))
    found = quality_by_passages(docs, labels)
    predicted = F.when(F.col("score") >= GOOD, 1).otherwise(0).cast("int")
    return found.select("doc_id", "held_out", "score", predicted.alias("predicted"))
