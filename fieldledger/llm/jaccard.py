"""N-gram Jaccard join by T-occurrence search with DivideSkip.

A document is the set of its distinct word n-grams, known by 64-bit hashes; equal sets
are one node. Two nodes link when they share at least `share` percent of their union.

1. Clusters. Linked sets differ in few n-grams: at most D of them for sizes up to some
   bound. Cut by hash into D + 1 parts, they agree in at least one whole part. So each
   set gives the digests of its parts (see `part_digests`), and sets that share a digest
   are put into one cluster; no link leaves a cluster. Digests are sorted over range partitions, and
   neighbours give the edges, so a digest that many sets share is spread over tasks
   and gives one edge per set.
2. Search. The members of a cluster, in shards of bounded size, are indexed by
   inverted lists. A set asks for all sets that share at least T of its n-grams. Its
   longest lists, fewer than T, are put aside; the short ones are merged over a heap,
   skipping ahead where too few lists agree (very many elements are counted as arrays
   instead); each candidate is then looked up in the long lists by binary search. A set that is already in the component of the
   cluster's first member needs no search of its own: whatever it links with is
   either in that component too or searches itself. Sets outside of it are searched in
   the other shards of their cluster as well.
3. Links, at most one per set and component that a search has found, make components.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from math import ceil, exp, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import components, numbered_rows, sized, slices, text_or_empty, without_rows
from fieldledger.llm.registry import query, table
from fieldledger.llm.words import mixed, windows_hash, words_of
from fieldledger.scratch import staged

#: n-grams of the sets of one shard that a task indexes at once.
SHARD_GRAMS = 1_000_000

#: Sets are compared within bands of sizes; a band's upper bound is so many times its lower one.
BAND = 1.5

#: Weight of the long lists in DivideSkip's choice of how many there are.
_MU = 0.0085

#: Elements of short lists that are merged over a heap. More of them are counted as arrays,
#: and so many lists are put aside as cost least if a probe costs as much as _PROBE counts.
HEAP, _PROBE = 2000, 30

_PART = np.uint64(0xD1B54A32D192ED03)

#: So few parts, or so many n-grams a part, are cut with one part more than differences.
FEW, LARGE = 8, 5

#: Digests of a set where parts are fewer and larger; a link is missed with a chance of 10 ** -11.
DIGESTS = 100


# sets --------------------------------------------------------------------------------


def gram_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's word n-grams, A-Z folded.

    A text with fewer words, but at least one, is one n-gram of all its words.
    """
    w = words_of(texts, lower=True)
    all_windows = windows_hash(w.hash, words)
    out = []
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(all_windows[a : b - words + 1]))
        else:
            out.append(windows_hash(w.hash[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def _digest(grams: np.ndarray) -> bytes:
    """128 bits that tell sets apart; the same for the same set."""
    n = np.uint64(len(grams))
    halves = [mixed(grams ^ s).sum(dtype=np.uint64) + n for s in (np.uint64(1), _PART)]
    return mixed(np.array(halves, np.uint64)).tobytes()


def bands(n: int, share: int) -> list[tuple[int, int, int]]:
    """The bands, by number, parts and least size, in which a set of `n` meets its partners.

    A band holds sizes from one bound up to the next; a pair meets in the band of its
    smaller set, so larger partners of a band's sizes belong to it as well.
    """
    out, band, low = [], 0, 1
    while low <= n:
        top = max(low + 1, int(low * BAND)) - 1
        largest = top * 100 // share
        if n <= largest:
            apart = (100 - share) * (top + largest) // (100 + share)
            out.append((band, apart + 1, low))
        band, low = band + 1, top + 1
    return out


def _cut(spread: np.ndarray, parts: int, label: int) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the parts, and which of them are empty."""
    part = (spread % np.uint64(parts)).astype(np.int64)
    sums = np.zeros(parts, np.uint64)
    np.add.at(sums, part, spread)
    names = mixed(np.arange(parts, dtype=np.uint64) + np.uint64(label << 32))
    return mixed(sums ^ names), np.bincount(part, minlength=parts) == 0


def part_digests(grams: np.ndarray, share: int) -> np.ndarray:
    """Digests of the parts of a set, for each band that it belongs to.

    A digest tells the band and the part. With one part more than linked sets can differ
    in, they agree in a whole one. That a part is empty says little, so an empty one is
    told further by the parts of a second, independent cut, unless there are so many
    parts that linked sets agree in others.

    Where such parts would be small, texts with one passage in common would share them
    as well. There, sets are cut into fewer and larger parts, several times: linked sets
    differ in at most 1.5 n-grams a part on average, each part agrees with a chance of
    0.22 or more, and of `DIGESTS` of them none does with a chance of 0.78 ** DIGESTS.

    Sizes so small that linked sets are equal have one part; they need no digest.
    """
    out = []
    for band, parts, low in bands(len(grams), share):
        label = (band + 1) * 1_000_003
        if parts == 1:
            continue
        if parts <= FEW or low >= LARGE * parts:
            digests, empty = _cut(mixed(grams ^ _PART), parts, label)
            out.append(digests[~empty])
            if parts <= FEW or parts * exp(-low / parts) <= 1:
                again = mixed(grams + _PART)
                for i in np.flatnonzero(empty):
                    out.append(_cut(again, parts, label + 1 + int(i))[0])
        else:
            fewer = ceil((parts - 1) / 1.5)
            for i in range(ceil(DIGESTS / fewer)):
                other = np.uint64(int(_PART) * (2 * i + 3) % (1 << 64))
                digests, empty = _cut(mixed(grams + other), fewer, label + 1 + i)
                out.append(digests[~empty])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class _Sets:
    def __init__(self, words: int, share: int):
        self.words, self.share = words, share

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = gram_sets(batch.column("text").to_pylist(), self.words)
            parts = [part_digests(x, self.share).tobytes() for x in sets]
            columns = [
                batch.column("row"),
                batch.column("doc"),
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array([_digest(x) for x in sets], pa.binary()),
                pa.array(parts, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc", "n", "digest", "parts"])


class _Grams:
    """The n-grams themselves, by digest."""

    def __init__(self, words: int):
        self.words = words

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = gram_sets(batch.column("text").to_pylist(), self.words)
            columns = [
                pa.array([_digest(x) for x in sets], pa.binary()),
                pa.array([x.tobytes() for x in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "grams"])


# clusters ----------------------------------------------------------------------------


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "parts"):
        parts = [np.frombuffer(x, np.int64) for x in batch.column("parts").to_pylist()]
        nodes = np.repeat(batch.column("node").to_numpy(), [len(x) for x in parts])
        flat = np.concatenate(parts)
        for i in range(0, len(flat), 200_000):
            columns = [pa.array(flat[i : i + 200_000]), pa.array(nodes[i : i + 200_000])]
            yield pa.RecordBatch.from_arrays(columns, ["part", "node"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from the first node of each run of equal digests in a sorted partition.

    A run may begin or end in another partition, so the first and the last run hand on
    (digest, first node) as well.
    """
    digest, first, begun, known = None, None, False, set()

    def batch(parts, a, b):
        columns = [pa.array(parts, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["part", "a", "b"])

    for rows in batches:
        if not rows.num_rows:
            continue
        part, node = rows.column("part").to_numpy(), rows.column("node").to_numpy()
        new = np.flatnonzero(np.diff(part) != 0) + 1
        starts = np.concatenate(([0], new))
        heads = node[starts]
        if digest == part[0]:
            heads[0] = first
        elif not begun:
            yield batch([part[0]], [heads[0]], [None])
        begun, digest, first = True, part[-1], heads[-1]
        head = np.repeat(heads, np.diff(np.append(starts, len(part))))
        apart = head != node
        pairs = set(zip(head[apart].tolist(), node[apart].tolist(), strict=True)) - known
        if pairs:
            a, b = zip(*pairs, strict=True)
            yield batch([None] * len(pairs), a, b)
        known = pairs if len(known) > 500_000 else known | pairs
    if begun:
        yield batch([digest], [first], [None])


def _edges(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) between nodes that share the digest of a part; see `_neighbours`."""
    rows = nodes.select("node", "parts").mapInArrow(_explode, "part long, node long")
    ordered = rows.repartitionByRange("part", "node").sortWithinPartitions("part", "node")
    found = staged(ordered.mapInArrow(_neighbours, "part long, a long, b long"), "neighbours")
    # One or two rows per partition.
    ends = found.where("part is not null").groupBy("part").agg(F.collect_set("a").alias("ends"))
    ends = ends.where(F.size("ends") > 1)
    joined = ends.select(F.array_min("ends").alias("a"), F.explode("ends").alias("b"))
    inner = found.where("part is null").select("a", "b")
    return inner.unionByName(joined.where("a <> b")).distinct()


# search ------------------------------------------------------------------------------


def heap_merge(lists: list[np.ndarray], least: int) -> dict[int, int]:
    """How often each element occurs that at least `least` of the sorted lists hold.

    The lists' heads lie on a heap. Where fewer heads agree, as many more are taken off
    as could not reach `least` without the next one, and their lists skip ahead to it.
    """
    lists = [x.tolist() for x in lists if len(x)]
    at = [0] * len(lists)
    heap = [(x[0], i) for i, x in enumerate(lists)]
    heapq.heapify(heap)
    out: dict[int, int] = {}
    while len(heap) >= least:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= least:
            out[top] = len(popped)
            target = top + 1
        else:
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap)[1])
            if not heap:
                break
            target = heap[0][0]
        for i in popped:
            at[i] = bisect_left(lists[i], target, at[i])
            if at[i] < len(lists[i]):
                heapq.heappush(heap, (lists[i][at[i]], i))
    return out


class Index:
    """Inverted lists of some sets, and the search for all that link with a set."""

    def __init__(self, sets: list[np.ndarray], share: int):
        self.share = share
        self.sizes = np.array([len(x) for x in sets], np.int64)
        grams = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(grams, kind="stable")
        grams, self.owner = grams[order], owner[order]
        new = np.flatnonzero(np.diff(grams, prepend=grams[:1] ^ np.uint64(1)) != 0)
        self.grams, self.start = grams[new], np.append(new, len(grams))
        place = np.repeat(np.arange(len(new)), np.diff(self.start))
        self.pairs = place * max(1, len(sets)) + self.owner

    def linked(self, x: np.ndarray) -> np.ndarray:
        """The sets that share at least `share` percent of the union with `x`."""
        none = np.zeros(0, np.int64)
        if not len(x) or not len(self.grams):
            return none
        n, share = len(x), self.share
        least = -(-n * share // 100)
        at = np.minimum(np.searchsorted(self.grams, x), len(self.grams) - 1)
        at = at[self.grams[at] == x]
        if len(at) < least:
            return none
        lengths = self.start[at + 1] - self.start[at]
        order = np.argsort(lengths, kind="stable")
        at, total = at[order], np.concatenate(([0], np.cumsum(lengths[order])))
        longest = int(total[-1] - total[-2])
        aside = min(least - 1, int(least / (_MU * log2(longest) + 1)))
        heap = total[len(at) - aside] <= HEAP
        if not heap:
            asides = np.arange(least)
            merged = total[len(at) - asides]
            probes = asides * np.minimum(merged / (least - asides), len(self.sizes))
            aside = int(np.argmin(merged + _PROBE * probes))
        short, long_ = at[: len(at) - aside], at[len(at) - aside :]
        lists = [self.owner[self.start[i] : self.start[i + 1]] for i in short]
        if heap:
            merged = heap_merge(lists, least - aside)
            found = np.fromiter(merged.keys(), np.int64, len(merged))
            both = np.fromiter(merged.values(), np.int64, len(merged))
        else:
            counts = np.bincount(np.concatenate(lists), minlength=len(self.sizes))
            found = np.flatnonzero(counts >= least - aside)
            both = counts[found]
        sizes = self.sizes[found]
        near = 100 * np.minimum(n, sizes) >= share * np.maximum(n, sizes)
        found, both, sizes = found[near], both[near], sizes[near]
        step = max(1, 1_000_000 // max(1, aside))
        for i in range(0, len(found), step):
            keys = long_[None, :] * len(self.sizes) + found[i : i + step, None]
            place = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            both[i : i + step] += (self.pairs[place] == keys).sum(axis=1)
        return found[100 * both >= share * (n + sizes - both)]


class _Search:
    """Links within each (cluster, shard), from rows that lie together.

    Role 0 is the cluster's first set, 1 a member of the shard, 2 a set from another
    shard, which only asks. Gives (a, b) for links, and (a, null) for a member that is
    not in the first set's component while its cluster has more shards.
    """

    def __init__(self, share: int):
        self.share = share

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, index = None, [], None
        out: list[tuple[int, int | None]] = []
        for batch in batches:
            names = ("cluster", "shard", "shards", "role", "node", "grams")
            for *group, shards, role, node, grams in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if group != key:
                    out += self._within(members, index)
                    key, members, index = group, [], None
                grams = np.frombuffer(grams, np.uint64)
                if role < 2:
                    if not members or members[-1][0] != node:
                        members.append((node, grams, role, shards))
                else:
                    index = index or Index([m[1] for m in members], self.share)
                    out += [(node, members[y][0]) for y in index.linked(grams).tolist()]
            if out:
                yield self._rows(out)
                out = []
        out += self._within(members, index)
        if out:
            yield self._rows(out)

    @staticmethod
    def _rows(out):
        a, b = (pa.array(x, pa.int64()) for x in zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([a, b], ["a", "b"])

    def _within(self, members, index) -> list[tuple[int, int | None]]:
        if not members or index is not None:
            return []
        index = Index([m[1] for m in members], self.share)
        root = list(range(len(members)))

        def top(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        out: list[tuple[int, int | None]] = []
        for i, (node, grams, _, _) in enumerate(members):
            if i and top(i) == top(0):
                continue
            for j in index.linked(grams).tolist():
                if (a := top(i)) != (b := top(j)):
                    root[max(a, b)] = min(a, b)
                    out.append((node, members[j][0]))
        open_ = [(m[0], None) for i, m in enumerate(members) if m[3] > 1 and top(i) != top(0)]
        return out + open_


_MEMBER = "cluster", "shard", "shards", "role", "node", "grams"


def _searched(rows: DataFrame, share: int, name: str) -> DataFrame:
    near = rows.select(*_MEMBER).repartition("cluster", "shard")
    near = near.sortWithinPartitions("cluster", "shard", "role", "node")
    return staged(near.mapInArrow(_Search(share), "a long, b long"), name)


def jaccard_components(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    words: int = 3,
    share: int = 90,
    row: str | None = None,
    shard_grams: int = SHARD_GRAMS,
) -> DataFrame:
    """One row per document: (row,) doc_id, n_shingles, component_id and kept.

    component_id is the smallest id that links reach, the document's own included;
    `kept` is true for one row of each component, of rows with that id the first one
    read. A text without words, or a null one, has an empty set and is linked with
    nothing. Null ids come last. Rows with equal sets are linked whatever their ids. An
    empty table gives an empty result; columns other than these are not read.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    slim = docs.select(
        number.alias("row"), F.col(doc).alias("doc"), text_or_empty(text).alias("text")
    )
    kind = slim.schema["doc"].dataType.simpleString()
    schema = f"row long, doc {kind}, n long, digest binary, parts binary"
    sets = staged(slim.mapInArrow(_Sets(words, share), schema), "gram-sets")
    full = sets.where("n > 0").select("row", "doc", "n", "digest")
    nodes = full.groupBy("digest").agg(
        F.min("row").alias("node"), F.min("doc").alias("doc"), F.first("n").alias("n")
    )
    nodes = staged(nodes, "gram-nodes")
    later = full.select("row", "digest").join(nodes.select("digest", "node"), "digest")
    later = staged(later.where("row <> node").select("row"), "equal-sets")
    first = sets.where("n > 0").join(sized(later), "row", "left_anti")
    edges = _edges(first.select(F.col("row").alias("node"), "parts"))
    clusters = components(edges).withColumnRenamed("root", "cluster")
    members = nodes.select("node", "digest", "doc", "n").join(clusters, "node")
    members = staged(members, "members")
    total = members.groupBy("cluster").agg(
        F.ceil(F.sum("n") / shard_grams).cast("int").alias("shards"),
        F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "node"))["node"].alias("hub"),
    )
    members = staged(members.join(sized(staged(total, "clusters")), "cluster"), "members")
    asked = sized(staged(members.select(F.col("doc").alias("wanted")).distinct(), "wanted"))
    texts = slim.join(asked, F.expr("doc <=> wanted"), "left_semi").select("text")
    grams = texts.mapInArrow(_Grams(words), "digest binary, grams binary")
    grams = grams.join(sized(members.drop("doc", "n")), "digest").drop("digest")
    own = F.pmod(F.xxhash64("node"), F.col("shards")).cast("int")
    grams = staged(grams.withColumn("own", own), "member-grams")
    is_hub = F.col("node") == F.col("hub")
    all_shards = F.sequence(F.lit(0), F.col("shards") - 1)
    first = grams.withColumn(
        "shard", F.explode(F.when(is_hub, all_shards).otherwise(F.array("own")))
    )
    links = _searched(first.withColumn("role", (~is_hub).cast("int")), share, "links")

    open_ = staged(links.where("b is null").select(F.col("a").alias("node")).distinct(), "open")
    if not open_.isEmpty():
        many = grams.where("shards > 1")
        others = F.explode(F.filter(all_shards, lambda s: s != F.col("own"))).alias("shard")
        asks = many.join(sized(open_), "node").select("*", others, F.lit(2).alias("role"))
        many = many.select("*", F.col("own").alias("shard"), F.lit(1).alias("role"))
        links = links.unionByName(_searched(many.unionByName(asks), share, "far-links"))
    roots = components(links).withColumnRenamed("node", "linked")
    ids = nodes.select("node", "digest").join(roots, F.col("node") == F.col("linked"), "left")
    ids = staged(ids.select("digest", F.coalesce("root", "node").alias("class")), "classes")
    rows = staged(
        sets.select("row", "doc", "n", "digest").join(ids, "digest", "left").drop("digest"), "rows"
    )
    order = F.struct(F.col("doc").isNull().alias("none"), "doc", "row")
    least = rows.where("class is not null").groupBy("class").agg(F.min(order).alias("first"))
    least = staged(least.select("class", F.col("first.doc").alias("least"), F.col("first.row").alias("keep")), "least")
    joined = rows.join(least, "class", "left")
    none = F.col("class").isNull()
    return joined.select(
        *([F.col("row").alias(row)] if row else []),
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(none, F.col("doc")).otherwise(F.col("least")).alias("component_id"),
        (none | (F.col("row") == F.col("keep"))).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, doc: str = "doc_id", **options) -> DataFrame:
    """`docs` with one document of each component, the one with the smallest id."""
    numbered, row = numbered_rows(docs, doc)
    groups = jaccard_components(numbered, doc=doc, row=row, **options)
    return without_rows(numbered, row, staged(groups.where("not kept").select(row), "copies"))


@query("op3_jaccard_join")
def op3_jaccard_join(spark, folder):
    found = jaccard_components(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")
