"""Runs: stretches of words that repeat with a period, found on a grammar of the words.

Re-Pair replaces the most frequent pair of neighbouring symbols by a new one until no
pair of a text occurs twice. A run that lies within one symbol and crosses the border
between its two parts is computed once, on the symbol's first occurrence, and moved to
all its places in the derivation. What is left of a text is halved in the same way, so
that every run crosses the border of the least symbol or half that holds it whole.

At a border, a run of at least four periods has two of them on one side. Running sums
of hashes tell which periods can have that; what they find is compared word by word.

Texts are independent of each other, so tasks take them in slices without a shuffle.
The symbols of one slice are handled together, as arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import slices, text_or_empty
from fieldledger.llm.registry import query, reach, table
from fieldledger.llm.words import _STEP, _power, mixed

#: A run has at least so many words, and at least so many periods.
LEAST, PERIODS = 6, 4

#: Pairs of a border and a period that are looked at together.
TESTS = 1_000_000


def word_ids(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each text, a number for each, and each word's text.

    Equal words of one text have one number; no two texts share any.
    """
    split = [t.split() for t in texts]  # of bytes: at ASCII white space alone
    ids = np.zeros(sum(map(len, split)), np.int64)
    at = used = 0
    for words in split:
        known = {w: i for i, w in enumerate(dict.fromkeys(words), used)}
        ids[at : at + len(words)] = [known[w] for w in words]
        at, used = at + len(words), used + len(known)
    return split, ids, np.repeat(np.arange(len(split)), list(map(len, split)))


class Grammar:
    """Rules symbol -> left right of the words `ids`, and the symbols that are left.

    `left`, `right`, `size` and `place` (of the first occurrence) have an entry for each
    symbol; words are their own symbols, below `words`. `rest` are the symbols that are
    left, `start` their places among the words and `text` their texts.
    """

    def __init__(self, ids: np.ndarray, text: np.ndarray):
        self.words = int(ids.max()) + 1 if len(ids) else 0
        none = np.full(self.words, -1, np.int64)
        self.left, self.right, self.place = none, none, none
        self.size = np.ones(self.words, np.int64)
        self.rest, self.start, self.text = ids, np.arange(len(ids)), text
        live = text[1:] == text[:-1]
        while live is not None:
            live = self._round(live)

    def _round(self, live: np.ndarray) -> np.ndarray | None:
        """Replaces in each text the most frequent pair, and with it all pairs that
        nowhere touch a more frequent one where they are replaced.

        `live` marks the places of pairs that may occur twice; so does what is returned.
        """
        at = np.flatnonzero(live)
        if len(at) < 2:
            return None
        rest = self.rest
        names, pair = np.unique((rest[at] << 32) | rest[at + 1], return_inverse=True)
        # in a stretch of equal pairs such as a a a a every other one counts
        again = np.concatenate(([False], (np.diff(pair) == 0) & (np.diff(at) == 1)))
        order = np.arange(len(at))
        counted = (order - np.maximum.accumulate(np.where(again, 0, order))) % 2 == 0
        often = np.bincount(pair[counted], minlength=len(names))
        rank = np.zeros(len(rest) + 1, np.int64)
        may = counted & (often[pair] > 1)
        rank[at[may]] = often[pair[may]] * len(names) + len(names) - pair[may]
        chosen = may & (rank[at] > rank[at - 1]) & (rank[at] > rank[at + 1])
        chosen &= np.bincount(pair[chosen], minlength=len(names))[pair] > 1
        if not chosen.any():
            return None
        first, number = np.unique(pair[chosen], return_index=True)[::-1]
        spot, symbol = at[chosen], np.searchsorted(number, pair[chosen]) + len(self.left)
        left, right = rest[spot[first]], rest[spot[first] + 1]
        self.left = np.concatenate((self.left, left))
        self.right = np.concatenate((self.right, right))
        self.place = np.concatenate((self.place, self.start[spot[first]]))
        self.size = np.concatenate((self.size, self.size[left] + self.size[right]))
        keep, new, still = np.ones(len(rest), bool), np.zeros(len(rest), bool), np.zeros(len(rest), bool)
        rest[spot], new[spot], keep[spot + 1] = symbol, True, False
        still[at] = often[pair] > 1
        self.rest, self.start, self.text = rest[keep], self.start[keep], self.text[keep]
        new, still = new[keep], still[keep]
        return (new[:-1] | new[1:] | still[:-1]) & (self.text[1:] == self.text[:-1])

    def borders(self) -> np.ndarray:
        """(begin, border, end) of each symbol with two parts, at its first occurrence."""
        own = slice(self.words, None)
        middle = self.place[own] + self.size[self.left[own]]
        return np.stack((self.place[own], middle, self.place[own] + self.size[own]), axis=1)

    def halves(self) -> np.ndarray:
        """(begin, border, end) of the nodes of balanced trees over what is left."""
        text, start = self.text, self.start
        end = start + self.size[self.rest]
        first = np.searchsorted(text, np.unique(text))
        many = np.diff(np.append(first, len(text)))
        out, width = [np.zeros((0, 3), np.int64)], 1
        while len(many) and width < many.max():
            pairs = (many + width - 1) // (2 * width)
            whose = np.repeat(np.arange(len(many)), pairs)
            turn = np.arange(len(whose)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            a = first[whose] + turn * 2 * width
            last = np.minimum(a + 2 * width, first[whose] + many[whose]) - 1
            out.append(np.stack((start[a], start[a + width], end[last]), axis=1))
            width *= 2
        return np.concatenate(out)

    def places(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, place) of all occurrences of the symbols of which `own` is true."""
        wanted, before = own.copy(), -1
        while before != (before := int(wanted.sum())):
            parts = slice(self.words, None)
            wanted[parts] |= wanted[self.left[parts]] | wanted[self.right[parts]]
        symbol, place = self.rest[wanted[self.rest]], self.start[wanted[self.rest]]
        symbols, places = [], []
        while len(symbol):
            symbols.append(symbol[own[symbol]])
            places.append(place[own[symbol]])
            wide = symbol >= self.words
            symbol, place = symbol[wide], place[wide]
            left, right = self.left[symbol], self.right[symbol]
            place = np.concatenate((place, place + self.size[left]))
            symbol = np.concatenate((left, right))
            symbol, place = symbol[wanted[symbol]], place[wanted[symbol]]
        if not symbols:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(symbols), np.concatenate(places)


def _exact(ids: np.ndarray, a: int, t: int, q: int, end: int) -> tuple[int, int]:
    """The stretch around `t` within [a, end) in which words `q` apart are equal."""

    def equal(step: int, most: int) -> int:
        done, width = 0, 64
        while done < most:
            width = min(width, most - done)
            low = t + done if step > 0 else t - done - width
            same = ids[low : low + width] == ids[low + q : low + q + width]
            if not same.all():
                other = np.flatnonzero(~same)
                return done + int(other[0] if step > 0 else width - 1 - other[-1])
            done, width = done + width, 2 * width
        return done

    return t - equal(-1, t - a), t + q + equal(1, end - q - t)


class Borders:
    """Runs that cross given borders, by running sums of hashes of the words."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        self.power = _power(_STEP, len(ids) + 1)
        self.sums = np.zeros(len(ids) + 1, np.uint64)
        values = mixed(ids.astype(np.uint64) + np.uint64(1))
        np.cumsum(values * self.power[: len(ids)], out=self.sums[1:])

    def _same(self, i, size, q):
        """Whether the hashes of `size` words from `i` and from `i + q` are equal."""
        one, two = self.sums[i + size] - self.sums[i], self.sums[i + q + size] - self.sums[i + q]
        return one * self.power[q] == two

    def _reach(self, low, most, fits):
        """The greatest `n` up to `most` for which `fits(n)`; it fits up to there."""
        high = most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            good = fits(middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low

    def _squares(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(node, anchor, period) where two periods stand on one side of the border."""
        out = [(np.zeros(0, np.int64),) * 3]
        for side in (0, 1):
            a, b, c = nodes.T
            most = np.minimum((c - a) // PERIODS, ((c - b) if side else (b - a)) // 2)
            upto = np.cumsum(most)
            begin = 0
            while begin < len(nodes):
                base = upto[begin] - most[begin]
                stop = max(begin + 1, int(np.searchsorted(upto, base + TESTS, side="right")))
                part = np.arange(begin, stop)
                which = np.repeat(part, most[part])
                q = np.arange(len(which)) - (np.repeat(upto[part] - most[part], most[part]) - base) + 1
                t = b[which] if side else b[which] - 2 * q
                hit = self._same(t, q, q)
                t = t[hit] if side else t[hit] + q[hit]
                out.append((which[hit], t, q[hit]))
                begin = stop
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def runs(self, nodes: np.ndarray) -> np.ndarray:
        """(node, period, start, end): runs that cross the border of a node, as far as
        they lie in it, of at least `LEAST` words and `PERIODS` periods."""
        node, t, q = self._squares(nodes)
        found = [np.zeros((0, 4), np.int64)]
        while len(node):
            # the least period of each node; others that its stretch explains are multiples
            order = np.lexsort((t, q, node))
            node, t, q = node[order], t[order], q[order]
            lead = np.flatnonzero(np.diff(node, prepend=-1))
            a, _, c = nodes[node[lead]].T
            at, p = t[lead], q[lead]
            ahead = self._reach(np.zeros_like(p), c - p - at, lambda n: self._same(at, n, p))
            behind = self._reach(np.zeros_like(p), at - a, lambda n: self._same(at - n, n, p))
            start, end = at - behind, at + p + ahead
            long = end - start >= np.maximum(LEAST, PERIODS * p)
            for i in np.flatnonzero(long).tolist():
                s, e = int(start[i]), int(end[i])
                if not np.array_equal(self.ids[s : e - p[i]], self.ids[s + p[i] : e]):
                    s, e = _exact(self.ids, int(a[i]), int(at[i]), int(p[i]), int(c[i]))
                    start[i], end[i] = s, e
                if e - s >= max(LEAST, PERIODS * p[i]):
                    found.append(np.array([[node[lead[i]], p[i], s, e]]))
            whose = np.searchsorted(lead, np.arange(len(node)), side="right") - 1
            side = np.where(t == nodes[node, 1], t, t - q)  # where the two periods begin
            left = (side < start[whose]) | (side + 2 * q > end[whose])
            left[lead] = False
            node, t, q = node[left], t[left], q[left]
        return np.concatenate(found)


def merged(runs: np.ndarray) -> np.ndarray:
    """Maximal (start, end, period), by start and period, of pieces of runs.

    Pieces with one period that share at least a period are one run; of equal stretches
    the one with the smallest period counts. No two texts share a place.
    """
    if not len(runs):
        return runs
    period, start, end = runs[np.lexsort((-runs[:, 2], runs[:, 1], runs[:, 0]))].T
    span = int(end.max()) + 1
    upto = np.maximum.accumulate(end + period * span) - period * span
    fresh = np.ones(len(period), bool)
    fresh[1:] = (np.diff(period) != 0) | (start[1:] + period[1:] > upto[:-1])
    first = np.flatnonzero(fresh)
    out = np.stack((start[first], np.maximum.reduceat(end, first), period[first]), axis=1)
    out = out[np.lexsort((out[:, 2], out[:, 1], out[:, 0]))]
    same = (np.diff(out[:, 0]) == 0) & (np.diff(out[:, 1]) == 0)
    out = out[np.concatenate(([True], ~same))]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def word_runs(ids: np.ndarray, text: np.ndarray) -> np.ndarray:
    """(start, end, period) of all runs of the words `ids`, by start and period."""
    if len(ids) < LEAST:
        return np.zeros((0, 3), np.int64)
    grammar, borders = Grammar(ids.copy(), text), Borders(ids)
    nodes = grammar.borders()
    wide = np.flatnonzero(nodes[:, 2] - nodes[:, 0] >= LEAST)
    inner = borders.runs(nodes[wide])
    symbol = wide[inner[:, 0]] + grammar.words
    rest = grammar.halves()
    outer = borders.runs(rest[rest[:, 2] - rest[:, 0] >= LEAST])[:, 1:]
    own = np.zeros(len(grammar.left), bool)
    own[symbol] = True
    if own.any():
        order = np.argsort(symbol, kind="stable")
        inner, symbol = inner[order], symbol[order]
        begin = np.searchsorted(symbol, np.arange(len(own) + 1))
        named, place = grammar.places(own)
        many = begin[named + 1] - begin[named]
        upto = np.cumsum(many)
        which = np.arange(int(many.sum())) - np.repeat(upto - many, many) + np.repeat(begin[named], many)
        moved = inner[which, 1:]
        moved[:, 1:] += (np.repeat(place, many) - grammar.place[symbol[which]])[:, None]
        outer = np.concatenate((outer, moved))
    return merged(outer)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        split, ids, text = word_ids(texts)
        first = np.searchsorted(text, np.arange(len(texts) + 1))
        runs = word_runs(ids, text)
        whose = text[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
        kept = np.ones(len(ids), bool)
        for start, end, period in runs.tolist():
            kept[start + period : end] = False
        cut = [
            b" ".join(w) if kept[a:b].all() else b" ".join([w[i] for i in np.flatnonzero(kept[a:b])])
            for w, a, b in zip(split, first[:-1].tolist(), first[1:].tolist(), strict=True)
        ]
        fields = [runs[:, 0] - first[whose], runs[:, 1] - runs[:, 0], runs[:, 2]]
        flat = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in fields], fields=list(_RUN))
        offsets = np.searchsorted(whose, np.arange(len(texts) + 1)).astype(np.int32)
        columns = [
            batch.column("doc"),
            pa.array([len(w) for w in split], pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), flat),
            pc.cast(pa.array(cut, pa.binary()), pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per document.

    `runs` are (start, length, period) in words, by start and then period: all stretches
    with smallest period `period` of at least six words and four periods that no
    neighbouring word extends. `collapsed` has the words that are not in a run after its
    first period, with one space between them. A null or empty text has no words, no runs
    and an empty `collapsed`; repeated rows are judged each for itself; an empty table
    gives an empty result; other columns are not read. A very long text is one slice of
    its own: its memory and time grow with its words, times the logarithm of their
    number for the time.
    """
    reach(docs.sparkSession)
    slim = docs.select(F.col(doc).alias("doc"), text_or_empty(text).alias("text"))
    kind = slim.schema["doc"].dataType.simpleString()
    return slim.mapInArrow(
        _found,
        f"doc_id {kind}, n_words long,"
        " runs array<struct<start: long, length: long, period: long>>, collapsed string",
    )


def with_period(text: Column, doc: Column) -> Column:
    """`text`, or for one document in ten the text with a periodic end put into it."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashed = F.crc32(doc.cast("string").cast("binary"))
    g = F.floor(hashed / 10).cast("long")

    def put(w):
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.when(n > 0, F.array_join(F.transform(places, lambda i: F.get(w, at(i).cast("int"))), " ")).otherwise("")

    one = F.transform(F.array(words), put)  # binds the list of words once
    return F.when(hashed % 10 == 0, F.get(one, F.lit(0))).otherwise(text)


@query("op13_periodic_runs")
def op13_periodic_runs(spark, folder):
    docs = table(spark, folder, "documents")
    text = F.coalesce("text", F.lit(""))
    found = periodic_runs(docs.select("doc_id", with_period(text, F.col("doc_id")).alias("text")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    order = lambda r: F.struct((-r.length).alias("shorter"), r.start, r.period)
    best = F.array_min(F.transform("runs", order))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        (-best["shorter"]).alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * -best["shorter"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
