"""Suffix-array deduplication of passages, by deep-shallow sorting of anchored suffixes.

A byte goes if it lies in a string of `LENGTH` bytes, a window, that also starts earlier:
in a document with a smaller id, or before in the same one. Windows are judged on the
input and never cross documents.

1. Anchors. Of the `GRAM`-byte strings within a window, the one with the least hash is
   its anchor. Equal windows have equal anchors at the same place, and about one
   position in 35 is an anchor, so only these are shuffled. Hashes that occur once are
   dropped. The windows of an anchor are neighbours; the bytes that they span are its
   context.
2. Copies. Anchors with equal contexts are sorted next to each other; all windows of all
   but the first are repeated.
3. Suffixes. The different contexts of one anchor are sorted twice: as suffixes, by the
   bytes from the anchor on, and by the bytes before it, read backwards. Multikey
   quicksort orders them to a shallow depth, on characters of several bytes, all
   segments advancing together; groups that still agree go to blind tries, which
   compare a string with one other only. The common prefixes of neighbours in both
   orders tell which windows are equal, for all distances from the anchor.
4. Ranges of repeated windows are merged for each document and cut out of its bytes.

Sorted rows are spread by ranges, so an anchor that very many documents share is not
gathered in one task. An anchor with more than `GROUP` different contexts is settled by
digests of its windows instead, which need no sorting together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import BROADCAST_ROWS, slices
from fieldledger.llm.registry import query, table
from fieldledger.llm.words import _BACK, _STEP, _power, mixed
from fieldledger.scratch import staged

LENGTH, GRAM = 100, 32

#: Contexts that are sorted at once, and the most that one anchor may bring there.
CHUNK, GROUP = 50_000, 100_000

#: Numbers in lists that are sent to all tasks; longer ones are joined by a shuffle.
LISTED = 16_000_000

#: Depth of the multikey quicksort: characters of so many bytes, so many of them.
_WIDE, _CHARACTERS = 7, 7

_PLACE = 28  #: bits of a place within a slice, beside a hash
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))


# anchors -----------------------------------------------------------------------------


class Anchors:
    """The anchors of some texts, in order, and the windows that they stand for.

    at: place of the anchor's gram; low, high: first and last window start; doc: index of
    the text; nth: its place among the anchors of the text; hash: of the gram. Places
    count from the start of `data`, all texts joined; `begin` is where each text starts.
    """

    def __init__(self, texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
        self.length = length
        self.data = data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.begin = np.cumsum(sizes) - sizes
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * _power(_STEP, len(data)), out=self.total[1:])
        width = length - gram + 1
        count = len(data) - length + 1
        if count < 1:
            empty = np.zeros(0, np.int64)
            self.at = self.low = self.high = self.doc = self.nth = empty
            self.hash = empty.astype(np.uint64)
            return
        sums = self.total[gram:] - self.total[:-gram]
        hashes = mixed(sums * _power(_BACK, len(sums)))
        place = np.uint64(_PLACE)
        keyed = (hashes >> place << place) | np.arange(len(hashes), dtype=np.uint64)
        padded = np.full(-(-len(keyed) // width) * width, np.uint64(2**64 - 1))
        padded[: len(keyed)] = keyed
        blocks = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
        owner = np.repeat(np.arange(len(texts)), sizes)
        starts = np.flatnonzero(owner[:count] == owner[length - 1 :])
        at = (least[starts] & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
        new = np.flatnonzero(np.diff(at, prepend=-1) != 0)
        self.at, self.low = at[new], starts[new]
        self.high = starts[np.append(new[1:], len(starts)) - 1]
        self.doc, self.hash = owner[self.at], hashes[self.at]
        first = np.searchsorted(self.doc, np.arange(len(texts)))
        self.nth = np.arange(len(self.at)) - first[self.doc]

    def digests(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """64-bit digests of the bytes from low up to high, by a polynomial of their own."""
        step = np.uint64(int(_STEP) ^ 0x5A5A5A5A5A5A5A5A | 1)
        back = np.uint64(pow(int(step), -1, 1 << 64))
        if not hasattr(self, "other"):
            self.other = np.zeros(len(self.data) + 1, np.uint64)
            values = mixed(_BYTES[self.data])
            np.cumsum(values * _power(step, len(values)), out=self.other[1:])
            self.inverse = _power(back, len(values) + 1)
        return mixed((self.other[high] - self.other[low]) * self.inverse[low])

    def context(self, which: np.ndarray) -> np.ndarray:
        """Digests of contexts, with where in them the anchor and the windows are."""
        at, low, high = self.at[which], self.low[which], self.high[which]
        shape = ((at - low) * 1024 + (high - low)).astype(np.uint64)
        return mixed(self.digests(low, high + self.length) ^ mixed(shape + np.uint64(1)))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "bytes"):
        found = Anchors(batch.column("bytes").to_pylist())
        rows = batch.column("row").to_numpy()[found.doc]
        for i in range(0, len(rows), 200_000):
            part = slice(i, i + 200_000)
            columns = [found.hash[part].view(np.int64), rows[part], found.nth[part].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["hash", "row", "nth"])


def whole_runs(
    batches: Iterator[pa.RecordBatch], column: str
) -> Iterator[tuple[pa.RecordBatch, bool, bool]]:
    """Batches that end where the sorted `column` changes, with whether they hold the
    partition's first and last value."""
    held: list[pa.RecordBatch] = []
    first = True

    def joined(parts):
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy()
        begin = int(np.searchsorted(values, values[-1]))
        if held and (begin or held[-1].column(column)[0].as_py() != values[-1]):
            yield joined([*held, batch.slice(0, begin)]), first, False
            held, first = [], False
        elif begin:
            yield batch.slice(0, begin), first, False
            first = False
        held.append(batch.slice(begin))
    if held:
        yield joined(held), first, True


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by hash, those whose hash occurs again.

    A partition's first and last hash may go on in another one, so they stay as well.
    """
    for batch, first, last in whole_runs(batches, "hash"):
        hashes = batch.column("hash").to_numpy()
        same = np.diff(hashes) == 0
        again = np.zeros(len(hashes), bool)
        again[1:] |= same
        again[:-1] |= same
        if first:
            again |= hashes == hashes[0]
        if last:
            again |= hashes == hashes[-1]
        yield batch.filter(pa.array(again)).select(["row", "nth"])


# copies ------------------------------------------------------------------------------


def _chosen(batch: pa.RecordBatch) -> tuple[Anchors, np.ndarray, np.ndarray]:
    """The anchors of a slice, which of them are listed in `nth`, and the row of each."""
    found = Anchors(batch.column("bytes").to_pylist())
    lists = batch.column("nth")
    sizes = np.diff(lists.offsets.to_numpy())
    first = np.searchsorted(found.doc, np.arange(batch.num_rows))
    which = np.sort(np.repeat(first, sizes) + lists.flatten().to_numpy())
    return found, which, batch.column("row").to_numpy()[found.doc[which]]


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "bytes"):
        found, which, rows = _chosen(batch)
        origin = found.begin[found.doc[which]]
        columns = [
            found.hash[which].view(np.int64),
            found.context(which).view(np.int64),
            rows,
            found.nth[which].astype(np.int32),
            found.low[which] - origin,
            (found.high[which] - found.low[which]).astype(np.int32),
        ]
        for i in range(0, len(which), 200_000):
            part = [pa.array(x[i : i + 200_000]) for x in columns]
            yield pa.RecordBatch.from_arrays(part, ["hash", "context", "row", "nth", "low", "more"])


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, low, high, null) for contexts seen before, (row, null, null, nth) for the
    first of several contexts of one anchor, which are still to be compared."""
    for batch, first, last in whole_runs(batches, "hash"):
        hashes, contexts = (batch.column(c).to_numpy() for c in ("hash", "context"))
        new_hash = np.diff(hashes, prepend=hashes[0] ^ 1) != 0
        new = new_hash | (np.diff(contexts, prepend=contexts[0] ^ 1) != 0)
        run = np.cumsum(new_hash) - 1
        several = np.bincount(run, weights=new)[run] > 1
        if first:
            several |= run == 0
        if last:
            several |= run == run[-1]
        row, nth, low, more = (batch.column(c).to_numpy() for c in ("row", "nth", "low", "more"))
        keep = ~new | several
        names = ["row", "low", "high", "nth"]
        columns = [
            pa.array(row[keep]),
            pa.array(low[keep], mask=new[keep]),
            pa.array((low + more)[keep], mask=new[keep]),
            pa.array(nth[keep], mask=~new[keep]),
        ]
        yield pa.RecordBatch.from_arrays(columns, names)


# deep-shallow sorting ----------------------------------------------------------------


def _prefix(a: bytes, b: bytes) -> int:
    """How many leading bytes agree."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    apart = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - -(-apart.bit_length() // 8)


class _Branch:
    __slots__ = ("depth", "below")

    def __init__(self, depth: int):
        self.depth, self.below = depth, {}


def _at(text: bytes, depth: int) -> int:
    return text[depth] if depth < len(text) else -1


def blind_trie(texts: list[bytes]) -> tuple[list[int], list[int]]:
    """The order of `texts`, and for each in order its common prefix with the one before.

    A branch holds the depth at which texts part, and their bytes there. A text goes
    down by these bytes alone, is compared with the leaf that it comes to, and is put in
    at the depth where the two part.
    """
    root: _Branch | list[int] = [0]
    for i in range(1, len(texts)):
        text, node = texts[i], root
        while isinstance(node, _Branch):
            node = node.below.get(_at(text, node.depth)) or next(iter(node.below.values()))
        other = texts[node[0]]
        depth = _prefix(text, other)
        if depth == len(text) == len(other):
            node.append(i)
            continue
        above, node = None, root
        while isinstance(node, _Branch) and node.depth < depth:
            above, node = node, node.below[_at(text, node.depth)]
        if isinstance(node, _Branch) and node.depth == depth:
            node.below[_at(text, depth)] = [i]
            continue
        branch = _Branch(depth)
        branch.below = {_at(other, depth): node, _at(text, depth): [i]}
        if above is None:
            root = branch
        else:
            above.below[_at(text, above.depth)] = branch
    order, common = [], []
    todo: list[tuple[_Branch | list[int], int]] = [(root, 0)]
    while todo:
        node, before = todo.pop()
        if isinstance(node, _Branch):
            below = sorted(node.below.items(), reverse=True)
            todo += [(x, node.depth) for _, x in below[:-1]]
            todo.append((below[-1][1], before))
        else:
            order += node
            common += [before, *[len(texts[node[0]])] * (len(node) - 1)]
    return order, common


def deep_shallow(
    data: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings data[start : start + size] within their groups, and each
    one's common prefix with the one before it, -1 for the first of a group."""
    padded = np.concatenate((data, np.zeros(_WIDE, np.uint8))).astype(np.uint64) + np.uint64(1)
    order = np.argsort(group, kind="stable")
    segment = np.cumsum(np.diff(group[order], prepend=group[order[0]] - 1) != 0)
    common = np.full(len(order), -2, np.int64)
    common[np.diff(segment, prepend=0) != 0] = -1
    for character in range(_CHARACTERS):
        alone = np.bincount(segment)[segment] == 1
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        who, depth = order[open_], character * _WIDE
        key = np.zeros(len(who), np.uint64)
        for k in range(depth, depth + _WIDE):
            there = k < size[who]
            code = np.where(there, padded[np.where(there, start[who] + k, 0)], np.uint64(0))
            key = (key << np.uint64(9)) | code
        sort = np.lexsort((key, segment[open_]))
        order[open_], key = who[sort], key[sort]
        parted = (np.diff(segment[open_]) == 0) & (np.diff(key) != 0)
        bits = key[1:] ^ key[:-1]
        equal = np.zeros(len(bits), np.int64)
        for k in range(1, _WIDE):
            equal += bits < np.uint64(1 << 9 * (_WIDE - k))
        turns = open_[1:][parted]
        common[turns] = depth + equal[parted]
        segment = np.cumsum(common != -2)
    depth = _WIDE * _CHARACTERS
    raw = data.tobytes()
    bounds = np.flatnonzero(np.append(common != -2, True))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a > 1:
            who = order[a:b]
            texts = [raw[i + depth : i + n] if n > depth else b"" for i, n in zip(start[who].tolist(), size[who].tolist(), strict=True)]
            within, shared = blind_trie(texts)
            order[a:b] = who[within]
            common[a + 1 : b] = np.array(shared[1:]) + np.minimum(depth, size[who].max())
    return order, common


def repeated_windows(
    contexts: list[bytes], before: np.ndarray, group: np.ndarray, length: int = LENGTH
) -> np.ndarray:
    """Which windows of each context also lie in an earlier context of its group.

    `before` tells how many bytes stand before the anchor. Contexts come in the order of
    their places. The result has a row per context and a column for each distance of
    the anchor from a window's start.
    """
    sizes = np.array([len(c) for c in contexts], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    at = ends - sizes + before
    n = len(contexts)
    sides = []
    for text, start, size in ((data, at, ends - at), (data[::-1], len(data) - at, before)):
        order, common = deep_shallow(text, start, size, group)
        sides.append((order, common))
    out = np.zeros((n, int(before.max()) + 1), bool)
    for distance in range(out.shape[1]):
        valid = (before >= distance) & (ends - at >= length - distance)
        if valid.sum() < 2:
            continue
        keys = []
        for (order, common), depth in zip(sides, (length - distance, distance), strict=True):
            classes = np.empty(n, np.int64)
            classes[order] = np.cumsum(common < depth)
            keys.append(classes)
        who = np.flatnonzero(valid)
        _, first = np.unique(keys[0][who] * (n + 1) + keys[1][who], return_index=True)
        out[np.delete(who, first), distance] = True
    return out


# ranges ------------------------------------------------------------------------------


def _full_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "bytes"):
        found, which, rows = _chosen(batch)
        low, high = found.low[which], found.high[which] + found.length
        origin, data = found.begin[found.doc[which]], found.data.tobytes()
        names = ["hash", "row", "low", "before", "bytes"]
        for i in range(0, len(which), 20_000):
            part = slice(i, i + 20_000)
            texts = [data[a:b] for a, b in zip(low[part], high[part], strict=True)]
            columns = [
                pa.array(found.hash[which[part]].view(np.int64)),
                pa.array(rows[part]),
                pa.array((low - origin)[part]),
                pa.array((found.at[which] - low)[part].astype(np.int32)),
                pa.array(texts, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, low, high) of repeated windows, from contexts sorted by hash and place."""
    held, size = [], 0

    def ranges():
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        row, low, before, hashes = (batch.column(c).to_numpy() for c in ("row", "low", "before", "hash"))
        order = np.lexsort((low, row))
        texts = batch.column("bytes").to_pylist()
        _, group = np.unique(hashes, return_inverse=True)
        before = before.astype(np.int64)[order]
        again = repeated_windows([texts[i] for i in order], before, group[order])
        # A window at distance d begins d bytes before the anchor: reversed, ranges ascend.
        edges = np.diff(np.pad(again[:, ::-1].astype(np.int8), ((0, 0), (1, 1))), axis=1)
        who, begin = np.nonzero(edges == 1)
        _, end = np.nonzero(edges == -1)
        place = low[order][who] + before[who] - (again.shape[1] - 1)
        columns = [row[order][who], place + begin, place + end - 1]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["row", "low", "high"])

    for batch, _, _ in whole_runs(batches, "hash"):
        if held and size + batch.num_rows > CHUNK:
            yield ranges()
            held, size = [], 0
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
    if held:
        yield ranges()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two digests of every window of a context, with its place."""
    for batch in slices(batches, "bytes", 200_000):
        texts = batch.column("bytes").to_pylist()
        found = Anchors(texts)
        count = np.array([max(0, len(t) - found.length + 1) for t in texts])
        owner = np.repeat(np.arange(len(texts)), count)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        begin = found.begin[owner] + inner
        sums = found.total[begin + found.length] - found.total[begin]
        columns = [
            mixed(sums * _power(_BACK, len(found.data) + 1)[begin]).view(np.int64),
            found.digests(begin, begin + found.length).view(np.int64),
            batch.column("row").to_numpy()[owner],
            batch.column("low").to_numpy()[owner] + inner,
        ]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["a", "b", "row", "low"])


def _by_digests(contexts: DataFrame) -> DataFrame:
    """(row, low, high) of repeated windows, each window for itself."""
    each = contexts.mapInArrow(_windows, "a long, b long, row long, low long")
    each = staged(each, "windows")
    first = each.groupBy("a", "b").agg(F.min(F.struct("row", "low")).alias("first"))
    first = staged(first, "first-windows")
    later = each.join(first, ["a", "b"]).where("struct(row, low) <> first")
    return later.select("row", "low", F.col("low").alias("high"))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document with its removed spans, from ranges sorted by row and low."""
    for batch, _, _ in whole_runs(batches, "row"):
        row, low, high = (batch.column(c).to_numpy() for c in ("row", "low", "high"))
        if not len(row):
            continue
        # Rows are moved apart, so that one running maximum serves all documents.
        shift = np.cumsum(np.diff(row, prepend=row[0]) != 0) * (int(high.max()) + LENGTH + 2)
        begin, end = low + shift, high + LENGTH + shift
        reach = np.maximum.accumulate(end)
        new = np.flatnonzero(np.append(True, begin[1:] > reach[:-1]))
        last = np.append(new[1:], len(row)) - 1
        begin, end, owner = low[new], reach[last] - shift[last], row[new]
        heads = np.flatnonzero(np.diff(owner, prepend=owner[0] - 1) != 0)
        offsets = pa.array(np.append(heads, len(owner)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (begin, end)]
        yield pa.RecordBatch.from_arrays([pa.array(owner[heads]), *lists], ["row", "begin", "end"])


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "bytes"):
        columns = (batch.column(c).to_pylist() for c in ("bytes", "begin", "end"))
        kept = []
        for text, begin, end in zip(*columns, strict=True):
            if begin:
                text = b"".join(text[a:b] for a, b in zip([0, *end], [*begin, len(text)], strict=True))
            kept.append(text)
        names = ["doc", "n_bytes", "begin", "end", "kept"]
        head = [batch.column(c) for c in names[:-1]]
        yield pa.RecordBatch.from_arrays([*head, pa.array(kept, pa.binary())], names)


# the operator ------------------------------------------------------------------------


def _in_order(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(row, doc, bytes): row is the id itself if ids are whole numbers, all different.

    Otherwise the texts are sorted by id, null ids last and equal ids by a hash of their
    texts, and numbered in that order in a written table.
    """
    raw = F.coalesce(F.col(text).cast("string").cast("binary"), F.lit(b"")).alias("bytes")
    slim = docs.select(F.col(doc).alias("doc"), raw)
    if slim.schema["doc"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        ids = slim.groupBy("doc").count()
        if ids.where("doc is null or count > 1").isEmpty():
            return slim.select(F.col("doc").cast("long").alias("row"), "doc", "bytes")
    order = F.col("doc").asc_nulls_last(), F.xxhash64("bytes")
    ordered = slim.repartitionByRange(*order).sortWithinPartitions(*order, "bytes")
    return staged(ordered.select(F.monotonically_increasing_id().alias("row"), "*"), "in-order")


def _with_lists(texts: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
    """`texts` with lists by row; sent to all tasks if they have at most LISTED numbers."""
    numbers = sum(F.size(c) for c in columns)
    total, count = rows.agg(F.sum(numbers), F.count("*")).first()
    small = (total or 0) <= LISTED and count <= BROADCAST_ROWS
    return texts.join(F.broadcast(rows) if small else rows, "row", "left")


def _listed(rows: DataFrame, name: str) -> DataFrame:
    """The anchors of each row, a list no longer than its text."""
    return staged(rows.groupBy("row").agg(F.collect_set("nth").alias("nth")), name)


def repeated_spans(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc, n_bytes, begin, end, kept.

    begin and end are the bounds of the removed spans, null if there are none; kept are
    the bytes that stay. A null text is an empty one. Of rows with one id, or without
    an id, those with smaller text hashes are the earlier ones. An empty table gives an
    empty result; other columns are not read.
    """
    texts = _in_order(docs, doc, text)
    plain = texts.select("row", "bytes")
    anchors = plain.mapInArrow(_anchor_rows, "hash long, row long, nth int")
    near = anchors.repartitionByRange("hash", "row").sortWithinPartitions("hash", "row")
    lists = _listed(near.mapInArrow(_repeated, "row long, nth int"), "repeated-anchors")

    def listed(lists):
        return _with_lists(plain, lists, "nth").where("nth is not null")

    rows = listed(lists).mapInArrow(
        _context_rows, "hash long, context long, row long, nth int, low long, more int"
    )
    keys = "hash", "context", "row", "nth"
    near = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    found = staged(near.mapInArrow(_copies, "row long, low long, high long, nth int"), "copies")
    copies = found.where("nth is null").select("row", "low", "high")
    lists = _listed(found.where("nth is not null"), "contexts-to-sort")
    schema = "hash long, row long, low long, before int, bytes binary"
    contexts = listed(lists).mapInArrow(_full_contexts, schema)
    contexts = staged(contexts, "contexts")
    large = contexts.groupBy("hash").count().where(F.col("count") > GROUP).select("hash")
    large = staged(large, "large-groups")
    small = contexts
    parts = [copies]
    if not large.isEmpty():
        small = contexts.join(large, "hash", "left_anti")
        parts.append(_by_digests(contexts.join(large, "hash", "left_semi")))
    sorted_ = small.repartition("hash").sortWithinPartitions("hash", "row", "low")
    parts.append(sorted_.mapInArrow(_compare, "row long, low long, high long"))
    ranges = parts[0]
    for more in parts[1:]:
        ranges = ranges.unionByName(more)
    ranges = ranges.repartition("row").sortWithinPartitions("row", "low")
    spans = ranges.mapInArrow(_merge, "row long, begin array<long>, end array<long>")
    spans = staged(spans, "spans")
    cut = _with_lists(texts, spans, "begin", "end").select(
        "doc", F.octet_length("bytes").cast("long").alias("n_bytes"), "begin", "end", "bytes"
    )
    kind = cut.schema["doc"].dataType.simpleString()
    return cut.mapInArrow(
        _cut_out, f"doc {kind}, n_bytes long, begin array<long>, end array<long>, kept binary"
    )


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark, folder):
    cut = repeated_spans(table(spark, folder, "documents"))
    return cut.select(
        F.col("doc").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.coalesce(F.size("begin"), F.lit(0)).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
