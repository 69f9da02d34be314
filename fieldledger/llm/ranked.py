"""Ranked lexical search over tries of restricted term vectors.

Documents are read once and reduced to the terms that some item has. For each item, a
block of documents becomes a trie: a document's vector is its terms that the item has as
well, the most frequent term first, so that documents with the same frequent terms share
a path. Vectors are kept sorted, which makes every subtree a range of rows: its tf maxima
and its smallest length bound what a document in it can score. The search goes depth
first into the child with the higher bound, and leaves out subtrees whose bound is below
the lowest of the best scores so far. These go on from block to block of a task, and only
a task's best rows per item are shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldledger.llm.common import slices, text_or_empty
from fieldledger.llm.registry import query, reach, table
from fieldledger.scratch import staged

#: How many documents an item gets.
TOP = 10

#: Different terms of the items that are searched in one pass; more items take more passes.
TERMS = 50_000

#: Entries of a block's vectors, and cells of one item's table of them.
ENTRIES, CELLS = 2_000_000, 2_000_000

#: Documents of a subtree that are scored at once instead of being bounded further.
LEAF = 128

#: Everything that is not part of a term becomes a space, and A-Z become a-z.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class _Vectors:
    """Each text's number of terms, and its different terms, of `known` if given, with tf."""

    def __init__(self, known: dict[bytes, int] | None):
        self.known = known

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            lengths, terms, counts, offsets = [], [], [], [0]
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = terms_of(text)
                lengths.append(len(words))
                tf = Counter(words)
                mine = tf.keys() if self.known is None else tf.keys() & self.known.keys()
                terms += mine if self.known is None else map(self.known.__getitem__, mine)
                counts += map(tf.__getitem__, mine)
                offsets.append(len(terms))
            names = pa.array(terms, pa.binary()) if self.known is None else pa.array(terms, pa.int32())
            names = names.cast(pa.string()) if self.known is None else names
            ends = pa.array(offsets, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, x) for x in (names, pa.array(counts, pa.int32()))]
            columns = [batch.column("doc"), pa.array(lengths, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "n", "terms", "counts"])


def term_vectors(slim: DataFrame, known: dict[bytes, int] | None = None) -> DataFrame:
    """(doc, n, terms, counts) of (doc, text); `terms` are texts, or numbers by `known`."""
    kind = slim.schema["doc"].dataType.simpleString()
    name = "string" if known is None else "int"
    return slim.mapInArrow(
        _Vectors(known), f"doc {kind}, n long, terms array<{name}>, counts array<int>"
    )


def part_scores(weight, tf, m):
    """What a term adds to a score; grows with `tf` and falls with `m`."""
    return weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))


class Best:
    """The highest scores of an item so far, equal ones by document; nulls are last."""

    def __init__(self, top: int):
        self.top, self.rows = top, []

    @property
    def floor(self) -> int:
        return self.rows[-1][0] if len(self.rows) == self.top else 1

    def add(self, scores: np.ndarray, docs: np.ndarray, names: pa.Array, order: np.ndarray) -> None:
        """Rows `docs` of `names` with these scores; `order` ranks the names."""
        good = np.flatnonzero(scores >= self.floor)
        if not len(good):
            return
        scores, docs = scores[good], docs[good]
        first = np.lexsort((order[docs], -scores))[: self.top]
        new = [(int(scores[i]), names[int(docs[i])].as_py()) for i in first]
        key = lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0)
        self.rows = sorted(self.rows + new, key=key)[: self.top]


class Trie:
    """Vectors of documents in the order of a trie; each subtree is a range of rows.

    `tf` has a row per document and a column per term, the most frequent term first; a
    document's path are the columns where it is not 0.
    """

    def __init__(self, tf: np.ndarray, m: np.ndarray, weight: np.ndarray):
        packed = np.packbits(tf > 0, axis=1)
        wide = np.zeros((len(tf), -(-packed.shape[1] // 8) * 8), np.uint8)
        wide[:, : packed.shape[1]] = packed
        keys = wide.view(">u8").astype(np.uint64)
        self.order = np.lexsort(keys.T[::-1])[::-1]  # those with the first term come first
        self.tf, self.m, self.weight = tf[self.order], m[self.order], weight

    def bound(self, a: int, b: int) -> int:
        """What no document of the subtree exceeds: its tf maxima at its smallest m."""
        return int(part_scores(self.weight, self.tf[a:b].max(axis=0), self.m[a:b].min()).sum())

    def search(self, best: Best, docs: np.ndarray, names: pa.Array, order: np.ndarray) -> None:
        """Adds the documents that are among the best; `docs` are the rows' documents."""
        docs, width = docs[self.order], self.tf.shape[1]
        open_ranges = [(self.bound(0, len(docs)), 0, len(docs), 0)]
        while open_ranges:
            bound, a, b, depth = open_ranges.pop()
            if bound < best.floor:
                continue
            while depth < width and b - a > LEAF:
                # all rows that share a path so far: with the next term, then without
                cut = a + int(np.count_nonzero(self.tf[a:b, depth]))
                depth += 1
                if a < cut < b:
                    sides = [(self.bound(x, y), x, y, depth) for x, y in ((a, cut), (cut, b))]
                    open_ranges += sorted(sides)  # the higher bound is taken next
                    break
            else:
                scores = part_scores(self.weight, self.tf[a:b], self.m[a:b, None]).sum(axis=1)
                best.add(scores, docs[a:b], names, order)


class _Search:
    """The best documents of each item among those of a task."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]], terms: int, total: int, length: int, top: int):
        self.items, self.terms, self.total, self.length, self.top = items, terms, total, length, top

    def block(self, rows: pa.Table, best: list[Best]) -> None:
        names = rows.column("doc").combine_chunks()
        order = np.empty(len(names), np.int64)
        order[pc.sort_indices(names, null_placement="at_end").to_numpy()] = np.arange(len(names))
        lists = rows.column("terms").combine_chunks()
        ends = lists.offsets.to_numpy()
        entry = lists.values.to_numpy()[ends[0] : ends[-1]]
        tf = rows.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(names)), np.diff(ends))
        m = 10 + (90 * rows.column("n").to_numpy() * self.total) // max(1, self.length)
        turn = np.argsort(entry, kind="stable")  # lists of documents, by term
        doc, tf = doc[turn], tf[turn]
        first = np.searchsorted(entry[turn], np.arange(self.terms + 1))
        for (terms, weight), mine in zip(self.items, best, strict=True):
            spans = [slice(first[t], first[t + 1]) for t in terms.tolist()]
            held = np.zeros(len(names), bool)
            for s in spans:
                held[doc[s]] = True
            docs = np.flatnonzero(held)
            if not len(docs):
                continue
            row = np.cumsum(held) - 1
            table = np.zeros((len(docs), len(terms)), np.int64)
            for column, s in enumerate(spans):
                table[row[doc[s]], column] = tf[s]
            step = max(1, CELLS // len(terms))
            for a in range(0, len(docs), step):
                part = docs[a : a + step]
                Trie(table[a : a + step], m[part], weight).search(mine, part, names, order)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, held, size, kind = [Best(self.top) for _ in self.items], [], 0, None
        widest = max((len(t) for t, _ in self.items), default=1)
        most = max(1, 8 * CELLS // max(1, widest))
        for whole in batches:
            kind = whole.schema.field("doc").type
            for a in range(0, whole.num_rows, most):
                batch = whole.slice(a, most)
                held.append(batch)
                size += len(batch.column("terms").flatten()) + batch.num_rows
                if size > ENTRIES or sum(x.num_rows for x in held) >= most:
                    self.block(pa.Table.from_batches(held), best)
                    held, size = [], 0
        if held:
            self.block(pa.Table.from_batches(held), best)
        rows = [(i, score, doc) for i, b in enumerate(best) for score, doc in b.rows]
        if rows:
            item, score, doc = zip(*rows, strict=True)
            columns = [pa.array(item, pa.int32()), pa.array(score, pa.int64()), pa.array(doc, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "score", "doc"])


def _item_terms(items: DataFrame, item: str, text: str, limit: int) -> tuple[DataFrame, int]:
    """(row, item_id, terms, block), staged, and the number of blocks.

    A block of items has about `limit` terms, whatever the number of items is.
    """
    slim = items.select(F.col(item).alias("doc"), text_or_empty(text).alias("text"))
    found = staged(term_vectors(slim).withColumn("row", F.monotonically_increasing_id()), "items")
    found = found.where(F.size("terms") > 0).select("row", F.col("doc").alias("item_id"), "terms")
    total = found.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // limit)
    return found.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(1, blocks)))), blocks


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    terms: int = TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of each item with a score above 0.

    Terms are runs of ASCII letters and digits and of all other characters from U+0080;
    A-Z count as a-z. A term weighs floor(1000 ln((2N + 2) / (2df + 1))), and a document
    adds w * (10^9 tf div (1000 tf + 8m)) for each term of the item, once, where m is
    10 + 90 n N div L for its n terms, N documents with terms and their L terms in all.
    Equal scores are ranked by document id, nulls last.

    Null and empty texts have no terms: such documents are never found, such items have no
    rows. Repeated documents and repeated items count each for themselves. Empty tables
    give an empty result; other columns are not read. A very long text is one slice of its
    own. Items are searched in passes over all documents, of about `terms` different terms
    each, so that what is sent to the tasks is bounded.
    """
    spark = docs.sparkSession
    reach(spark)
    asked, blocks = _item_terms(items, item, item_text, terms)
    slim = docs.select(F.col(doc).alias("doc"), text_or_empty(text).alias("text"))
    kind = slim.schema["doc"].dataType.simpleString()
    out = None
    for number in range(blocks):
        mine = asked.where(F.col("block") == number).orderBy("row").collect()
        names = sorted({t for r in mine for t in r.terms})
        known = {t.encode(): i for i, t in enumerate(names)}
        vectors = staged(term_vectors(slim, known), "vectors")
        total, length = vectors.where("n > 0").agg(F.count("*"), F.sum("n")).first()
        df = np.zeros(len(names), np.int64)
        for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[r.t] = r["count"]
        weight = np.floor(1000 * np.log((2 * total + 2) / (2 * df + 1))).astype(np.int64)
        lists = []
        for r in mine:
            numbers = np.array([known[t.encode()] for t in r.terms], np.int64)
            numbers = numbers[np.lexsort((numbers, -df[numbers]))]  # the most frequent first
            numbers = numbers[(df[numbers] > 0) & (weight[numbers] > 0)]
            lists.append((numbers, weight[numbers]))
        search = _Search(lists, len(names), total, length or 0, top)
        best = vectors.where(F.size("terms") > 0).mapInArrow(search, f"item int, score long, doc {kind}")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        ranked = staged(best, "best").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(mine)], f"item int, item_id {dict(asked.dtypes)['item_id']}")
        found = ranked.join(F.broadcast(ids), "item").select("item_id", "rank", F.col("doc").alias("doc_id"), "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        id_kind = dict(items.dtypes)[item]
        return spark.createDataFrame([], f"item_id {id_kind}, rank int, doc_id {kind}, score long")
    return out


@query("op11_ranked_search")
def op11_ranked_search(spark, folder):
    return ranked_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
