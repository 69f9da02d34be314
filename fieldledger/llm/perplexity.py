"""Quality rules: base rules, and perplexity bands per language.

The language model is an interpolated modified Kneser-Ney model over characters, one
for each language, of order `ORDER`. Tasks count n-grams of the texts that they read,
and Spark adds the counts. Those of a small model are sent to the tasks, as arrays of
sorted n-gram keys beside their counts and those of their contexts; those of a larger one
lie as files in the shared folder, which the tasks map and no one holds. Only beyond
`MAPPED_ROWS` does Spark derive the lower orders and join them with each text's n-grams,
which takes a row of figures for each n-gram of each text. An n-gram's key is its
characters, 12 bits each; code points above 2047 are hashed into 2,048 classes. Equal
texts of a language are counted once.

A text is scored by what the other texts brought to the counts: its own n-grams are taken
out at all orders, so those that no other text has back off. Its score is the mean
negative log probability of its characters, each after
the characters before it (padding stands before the first one). The mean of few
characters varies more, so deviations from the language's median are taken times the
square root of the text's length, and the median of their amounts, over all different
texts that pass the base rules, is the language's spread. So many spreads below and above
are the bands, wider for short texts; a text outside is rejected. Scores that lie high are
gibberish and foreign symbols, scores that lie low are text of few common n-grams. A text
that is alone in its language has nothing to be judged by and scores 0.
"""

from __future__ import annotations

import os
import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldledger.folders import copy_in, mounted, remove_folder
from fieldledger.llm.common import numbered_rows, sized, slices, without_rows
from fieldledger.llm.registry import query, reach, table
from fieldledger.llm.words import code_points, windows_hash, words_of
from fieldledger.scratch import scratch_path, staged

ORDER, BITS = 5, 12

#: Twice the longest n-grams of a model that is sent to the tasks, and of one whose arrays
#: are files; a larger one is joined.
MODEL_ROWS, MAPPED_ROWS = 2_000_000, 400_000_000

#: n-grams that the driver takes at once while it writes the files of a model.
BLOCK = 1 << 21

#: n-grams that a task holds before it hands on what it has counted.
HELD = 1_500_000

#: Half-widths of the bands in spreads of a language, the least spread, and what is added
#: for a text of any length, in nats a character.
BELOW, ABOVE, LEAST, MORE = 2.5, 4.75, 0.8, 0.02

#: Base rules: fewer words, or a larger share of words in repeated windows, fail.
MIN_WORDS, WINDOW, REPEATED = 10, 5, 0.2
SYMBOLS = "#*$%&|<>"

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


# n-grams of a slice of texts ---------------------------------------------------------


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The key of the ORDER-gram that ends at each character, and the lengths of the texts."""
    lengths = np.array([len(t) for t in texts], np.int64)
    points = code_points("".join(texts)).astype(np.uint64)
    hashed = (points * np.uint64(0x9E3779B1) >> np.uint64(11)) & np.uint64(2047)
    points = np.where(points < 2048, np.maximum(points, 1), hashed + np.uint64(2048))
    pad = ORDER - 1
    place = np.arange(len(points)) + np.repeat(np.arange(1, len(texts) + 1) * pad, lengths)
    padded = np.zeros(len(points) + pad * len(texts), np.uint64)
    padded[place] = points
    keys = np.zeros(len(points), np.uint64)
    for back in range(pad, -1, -1):
        keys = (keys << np.uint64(BITS)) | padded[place - back]
    return keys.astype(np.int64), lengths


def _languages(batch: pa.RecordBatch) -> dict[str, list[int]]:
    at = defaultdict(list)
    for i, lang in enumerate(batch.column("lang").to_pylist()):
        at[lang].append(i)
    return at


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = defaultdict(list), 0

    def merged(parts):
        keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        new = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
        return keys[new], np.add.reduceat(n, new)

    def out():
        for lang, parts in held.items():
            keys, n = merged(parts)
            for i in range(0, len(keys), 100_000):
                part = slice(i, i + 100_000)
                langs = pa.array([lang] * len(keys[part]), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [langs, pa.array(keys[part]), pa.array(n[part])], ["lang", "key", "n"]
                )

    for batch in slices(batches, "text"):
        texts = batch.column("text").to_pylist()
        for lang, at in _languages(batch).items():
            keys, _ = ngrams([texts[i] for i in at])
            if len(keys):
                held[lang].append(np.unique(keys, return_counts=True))
                size += len(held[lang][-1][0])
        if size > HELD:
            held = defaultdict(list, {k: [merged(v)] for k, v in held.items()})
            size = sum(len(v[0][0]) for v in held.values())
            if size > HELD / 2:
                yield from out()
                held, size = defaultdict(list), 0
    yield from out()


# the model ---------------------------------------------------------------------------


def _mask(order: int) -> int:
    return (1 << BITS * order) - 1


def top_counts(docs: DataFrame) -> DataFrame:
    """(lang, key, n), staged: occurrences of the n-grams of `docs` (lang, text)."""
    partial = docs.mapInArrow(_count, "lang string, key long, n long")
    return staged(partial.groupBy("lang", "key").agg(F.sum("n").alias("n")), "ngrams")


def lower_levels(counts: DataFrame) -> dict[int, DataFrame]:
    """`counts` and staged tables like it by order; a shorter n-gram's n is the number of
    different n-grams one longer that end with it."""
    levels = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        shorter = F.col("key").bitwiseAND(F.lit(_mask(k))).alias("key")
        levels[k] = levels[k + 1].groupBy("lang", shorter).agg(F.count("*").alias("n"))
        levels[k] = staged(levels[k], "lower-ngrams")
    return levels


# scores without a text's own counts --------------------------------------------------


def _discounts(times: list[int]) -> tuple[float, float, float]:
    """The discounts of an order by how many n-grams have the counts 1, 2, 3 and 4."""
    share = max(times[0], 1) / (max(times[0], 1) + 2 * times[1])
    cut = [i - (i + 1) * share * times[i] / max(times[i - 1], 1) for i in (1, 2, 3)]
    return tuple(min(max(x, 0.1), i - 0.1) for i, x in enumerate(cut, 1))


def narrow(x: np.ndarray) -> np.ndarray:
    """Counts in four bytes each, where they fit."""
    return x.astype(np.int32 if not len(x) or x.max() < 1 << 31 else np.int64)


class Counted:
    """A language's counts as arrays: n-grams of each order, where their context and the
    n-gram one shorter stand, and for each context its total and how many n-grams in it
    have the counts 1, 2 and more."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.keys, self.orders, self.cuts = keys, {}, {}
        for k in range(ORDER, 0, -1):
            new = np.diff(keys >> BITS, prepend=-1) != 0
            start = np.flatnonzero(new)
            sums = [np.add.reduceat(x, start, dtype=np.int64) for x in (n, n == 1, n == 2, n > 2)]
            self.cuts[k] = _discounts([int((n == i).sum()) for i in (1, 2, 3, 4)])
            shorter, at, more = np.unique(
                keys & _mask(k - 1), return_inverse=True, return_counts=True
            )
            context = (np.cumsum(new) - 1).astype(np.int32)
            self.orders[k] = narrow(n), context, list(map(narrow, sums)), at.astype(np.int32)
            self.symbols = len(keys)
            keys, n = shorter, more

    def figures(self, keys: np.ndarray):
        """For each order from the longest, the figures of `keys`, all of them counted ones."""
        at = np.searchsorted(self.keys, keys)
        for k in range(ORDER, 0, -1):
            n, context, sums, shorter = self.orders[k]
            yield tuple(x.astype(np.int64) for x in (n[at], *(x[context[at]] for x in sums)))
            at = shorter[at] if k > 1 else None


def counted(counts: DataFrame) -> dict[str | None, Counted]:
    rows = counts.select("lang", "key", "n").toArrow()
    if not rows.num_rows:
        return {}
    langs = rows.column("lang").combine_chunks().dictionary_encode()
    names = [*langs.dictionary.to_pylist(), None]
    code = langs.indices.fill_null(len(names) - 1).to_numpy(zero_copy_only=False)
    key, n = rows.column("key").to_numpy(), rows.column("n").to_numpy()
    del rows
    out = {}
    for c in np.unique(code).tolist():
        mine = np.flatnonzero(code == c)
        mine = mine[np.argsort(key[mine])]
        out[names[c]] = Counted(key[mine], n[mine])
    return out


SUMS = ["total", "ones", "twos", "more"]


class Mapped(Counted):
    """`Counted` whose arrays are files of a folder, by name and type. They are mapped where
    they are read, so that workers of a machine share them and none takes memory for them."""

    def __init__(self, folder: str, added: bool, kinds: dict[str, str], cuts: dict, symbols: int):
        self.folder, self.added, self.kinds, self.cuts, self.symbols = folder, added, kinds, cuts, symbols

    def __getattr__(self, name: str):
        if name not in ("keys", "orders"):
            raise AttributeError(name)
        folder = SparkFiles.get(self.folder) if self.added else self.folder
        x = {n: np.asarray(np.memmap(f"{folder}/{n}", kind, "r")) for n, kind in self.kinds.items()}
        own = {(int(n.split("-")[1]), n.split("-")[2]): a for n, a in x.items()}
        self.keys = own[ORDER, "key"]
        self.orders = {
            k: (own[k, "n"], own[k, "context"], [own[k, c] for c in SUMS], own.get((k, "shorter")))
            for k in range(ORDER, 0, -1)
        }
        return self.__dict__[name]

    def __reduce__(self):
        return Mapped, (self.folder, self.added, self.kinds, self.cuts, self.symbols)


class _Files:
    """The arrays of one language as files that grow, and their types."""

    def __init__(self, folder: str, language: int):
        self.folder, self.language, self.kinds, self.size = folder, language, {}, defaultdict(int)

    def name(self, k: int, array: str) -> str:
        return f"{self.language}-{k}-{array}"

    def append(self, k: int, array: str, x: np.ndarray) -> None:
        name = self.name(k, array)
        self.kinds.setdefault(name, x.dtype.str)
        self.size[k, array] += len(x)
        with open(f"{self.folder}/{name}", "ab") as file:
            x.tofile(file)

    def read(self, k: int, array: str, mode: str = "r") -> np.ndarray:
        name = self.name(k, array)
        return np.memmap(f"{self.folder}/{name}", self.kinds[name], mode)

    def drop(self, k: int, array: str) -> None:
        os.remove(f"{self.folder}/{self.name(k, array)}")
        del self.kinds[self.name(k, array)]

    def narrow(self, k: int, array: str) -> None:
        """Rewrites 64-bit counts that all fit in four bytes."""
        name = self.name(k, array)
        x = self.read(k, array)
        if max(int(x[a : a + BLOCK].max()) for a in range(0, len(x), BLOCK)) < 1 << 31:
            with open(f"{self.folder}/{name}-32", "wb") as file:
                for a in range(0, len(x), BLOCK):
                    x[a : a + BLOCK].astype(np.int32).tofile(file)
            os.replace(f"{self.folder}/{name}-32", f"{self.folder}/{name}")
            self.kinds[name] = np.dtype(np.int32).str

    def contexts(self, k: int) -> tuple[float, float, float]:
        """Writes the contexts of order `k`, block by block; returns its discounts."""
        keys, n = self.read(k, "key"), self.read(k, "n")
        times, found, a = [0] * 4, 0, 0
        while a < len(keys):
            # A block ends with a context, of which none has more n-grams than there are classes.
            b = min(a + BLOCK, len(keys))
            b += int(np.searchsorted(keys[b : b + (1 << BITS)] >> BITS, keys[b - 1] >> BITS, "right"))
            part, counts = np.asarray(keys[a:b]), np.asarray(n[a:b])
            new = np.diff(part >> BITS, prepend=-1) != 0
            start = np.flatnonzero(new)
            self.append(k, "context", (found + np.cumsum(new) - 1).astype(np.int32))
            for array, x in zip(SUMS, (counts, counts == 1, counts == 2, counts > 2), strict=True):
                kind = np.int64 if k == ORDER and array == "total" else np.int32
                self.append(k, array, np.add.reduceat(x, start, dtype=kind))
            times = [t + int((counts == i).sum()) for i, t in enumerate(times, 1)]
            found, a = found + len(start), b
        return _discounts(times)

    def shorten(self, k: int) -> None:
        """Writes the n-grams one shorter than those of order `k` and where each has its own,
        a range of them at a time."""
        keys = self.read(k, "key")
        sample = np.sort(keys[:: max(1, len(keys) >> 16)] & _mask(k - 1))
        parts = -(-len(keys) // BLOCK)
        bounds = np.unique(sample[np.arange(1, parts) * len(sample) // parts]).tolist()
        name = self.name(k, "shorter")
        self.kinds[name] = np.dtype(np.int32).str
        place = np.memmap(f"{self.folder}/{name}", np.int32, "w+", shape=keys.shape)
        found = 0
        for low, high in zip([0, *bounds], [*bounds, 1 << 62], strict=True):
            at = []
            for a in range(0, len(keys), BLOCK):
                short = keys[a : a + BLOCK] & _mask(k - 1)
                at.append(a + np.flatnonzero((short >= low) & (short < high)))
            at = np.concatenate(at)
            shorter, inverse, n = np.unique(keys[at] & _mask(k - 1), return_inverse=True, return_counts=True)
            place[at] = found + inverse
            self.append(k - 1, "key", shorter)
            self.append(k - 1, "n", n.astype(np.int32))
            found += len(shorter)
        place.flush()

    def finish(self) -> tuple[dict, int]:
        cuts = {}
        for k in range(ORDER, 0, -1):
            cuts[k] = self.contexts(k)
            if k > 1:
                self.shorten(k)
            if k < ORDER:
                self.drop(k, "key")
        for array in ("n", "total"):
            self.narrow(ORDER, array)
        return cuts, self.size[1, "n"]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a language, as the bytes of their keys and counts."""
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        cuts = [0, *(i for i in range(1, len(langs)) if langs[i] != langs[i - 1]), len(langs)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a < b:
                part = [batch.column(c).slice(a, b - a).to_numpy().tobytes() for c in ("key", "n")]
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([langs[a]], pa.string()), "keys": [part[0]], "ns": [part[1]]}
                )


def mapped(counts: DataFrame, rows: int) -> tuple[dict[str | None, Mapped], str]:
    """The models of `counts`, `rows` in all, as files of a folder that the tasks can map, and
    that folder.

    Spark sorts the n-grams; the driver gets them a piece after the other and writes each
    at once, so its memory does not grow with them. A shared folder that machines mount is
    mapped where it lies; from another store each machine gets a copy, as an added file.
    """
    spark = counts.sparkSession
    shared = scratch_path(spark, "model")
    mount = mounted(spark, shared)
    folder = mount or tempfile.mkdtemp(prefix="model-")
    os.makedirs(folder, exist_ok=True)
    ordered = counts.select("lang", "key", "n").repartitionByRange(max(1, -(-rows // BLOCK)), "lang", "key")
    ordered = ordered.sortWithinPartitions("lang", "key")
    pieces = ordered.mapInArrow(_packed, "lang string, keys binary, ns binary")
    written: dict[str | None, _Files] = {}
    for lang, keys, n in pieces.toLocalIterator():
        files = written.setdefault(lang, _Files(folder, len(written)))
        files.append(ORDER, "key", np.frombuffer(keys, np.int64))
        files.append(ORDER, "n", np.frombuffer(n, np.int64))
    done = {lang: files.finish() for lang, files in written.items()}
    if not mount:
        copy_in(spark, folder, shared)
        spark.sparkContext.addFile(shared, recursive=True)
    at = mount or shared.rpartition("/")[2]
    models = {lang: Mapped(at, not mount, written[lang].kinds, *x) for lang, x in done.items()}
    return models, shared


def nats_without_own(doc, keys, own, figures, cuts: dict, symbols: int) -> np.ndarray:
    """The negative log probability of all characters of each text 0, 1, ... of `doc`, under
    the model without what the text itself brought to the counts.

    Rows are the different n-grams of each text with their number, in the order of text
    and key. The text's occurrences are taken from the counts of the longest n-grams; one
    that only this text has is taken from the count of the n-gram one shorter, and so on
    down. The discounts are those of all texts.
    """
    p, weight = np.zeros(len(keys)), np.ones(len(keys))
    gone = np.arange(len(keys))
    for k, (n, total, *kinds) in zip(range(ORDER, 0, -1), figures, strict=True):
        if k == ORDER:
            at, less = gone, own
            new = (np.diff(doc, prepend=-1) != 0) | (np.diff(keys >> BITS, prepend=-1) != 0)
            start = np.flatnonzero(new)
            row_less, place, hit = own, np.cumsum(new) - 1, True
        else:
            packed = (doc << BITS * (ORDER - 1)) | (keys & _mask(k))
            lost, first, less = np.unique(packed[gone], return_index=True, return_counts=True)
            at = gone[first]
            start = np.flatnonzero(np.diff(lost >> BITS, prepend=-1))
            row_less = np.zeros(len(keys), np.int64)
            if len(lost):
                place = np.minimum(np.searchsorted(lost, packed), len(lost) - 1)
                row_less = np.where(lost[place] == packed, less[place], 0)
                contexts, packed = lost[start] >> BITS, packed >> BITS
                place = np.minimum(np.searchsorted(contexts, packed), len(contexts) - 1)
                hit = contexts[place] == packed
        before, after = n[at], n[at] - less
        if len(at):
            total = total - np.where(hit, np.add.reduceat(less, start)[place], 0)
            for i, of in enumerate((lambda x: x == 1, lambda x: x == 2, lambda x: x > 2)):
                change = of(after).astype(np.int64) - of(before)
                kinds[i] = kinds[i] + np.where(hit, np.add.reduceat(change, start)[place], 0)
        now, cut, some = n - row_less, cuts[k], total > 0
        total = np.maximum(total, 1)
        kept = now - np.array([0.0, *cut])[np.minimum(now, 3)]
        p += weight * np.where(some, kept / total, 0.0)
        weight *= np.where(some, sum(d * x for d, x in zip(cut, kinds, strict=True)) / total, 1.0)
        gone = at[after == 0]
    left = symbols - np.bincount(doc[gone], minlength=doc[-1] + 1)
    return np.bincount(doc, -own * np.log(p + weight / (left[doc] + 1)))


#: Texts whose numbers fit beside an n-gram of the second longest order.
TOGETHER = 1 << (62 - BITS * (ORDER - 1))


def own_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different n-grams of each text as rows: number of the text, key, occurrences."""
    keys, lengths = ngrams(texts)
    parts = [np.unique(x, return_counts=True) for x in np.split(keys, np.cumsum(lengths)[:-1])]
    doc = np.repeat(np.arange(len(parts)), [len(x) for x, _ in parts])
    return doc, np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts])


# scores and rules --------------------------------------------------------------------


def base_stats(texts: list[str]) -> list[np.ndarray]:
    """For each text the figures of the base rules, in the order of STATS."""
    w = words_of(texts)
    n = np.diff(w.first)
    length = np.concatenate(([0], np.cumsum(w.end - w.start)))
    chars = length[w.first[1:]] - length[w.first[:-1]]
    symbols = np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64)
    lines = np.array([_repeated_lines(t) for t in texts], np.int64)
    repeated = np.zeros(len(w.hash) + 1, np.int64)
    windows = windows_hash(w.hash, WINDOW)
    if len(windows):
        own = np.flatnonzero(w.doc[: len(windows)] == w.doc[WINDOW - 1 :])
        keys = windows[own]
        order = np.lexsort((keys, w.doc[own]))
        keys, own = keys[order], own[order]
        equal = (np.diff(keys) == 0) & (np.diff(w.doc[own]) == 0)
        twice = np.zeros(len(own), bool)
        twice[1:] |= equal
        twice[:-1] |= equal
        np.add.at(repeated, own[twice], 1)
        np.add.at(repeated, own[twice] + WINDOW, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(repeated)[:-1] > 0)))
    return [n, chars, symbols, lines, covered[w.first[1:]] - covered[w.first[:-1]]]


def _repeated_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


class _Score:
    """Base figures of each text, and its score if the model is at hand."""

    def __init__(self, arrays=None):
        self.arrays = arrays

    @property
    def models(self) -> dict:
        return self.arrays if isinstance(self.arrays, dict) else self.arrays.value

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            columns = [pa.array(x) for x in base_stats([t or "" for t in texts])]
            if self.arrays:
                nats = np.zeros(len(texts))
                for lang, at in _languages(batch).items():
                    at = np.array([i for i in at if texts[i]], np.int64)
                    for part in np.split(at, range(TOGETHER, len(at), TOGETHER)):
                        if len(part):
                            model = self.models[lang]
                            doc, keys, own = own_grams([texts[i] for i in part])
                            figures = model.figures(keys)
                            sums = nats_without_own(doc, keys, own, figures, model.cuts, model.symbols)
                            nats[part] = sums / [len(texts[i]) for i in part]
                columns.append(pa.array(nats))
            chars = pa.array([len(t) for t in texts], pa.int64())
            head = [batch.column("row"), batch.column("doc"), batch.column("lang"), chars]
            names = ["row", "doc", "lang", "chars", *STATS, *["nats"] * bool(self.arrays)]
            yield pa.RecordBatch.from_arrays(head + columns, names)


def _keys_by_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        texts, rows = batch.column("text").to_pylist(), batch.column("row").to_numpy()
        langs = batch.column("lang").to_pylist()
        for text, row, lang in zip(texts, rows, langs, strict=True):
            keys, n = np.unique(ngrams([text])[0], return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {"row": np.full(len(keys), row), "lang": pa.array([lang] * len(keys), pa.string()), "key": keys, "own": n}
            )


FIGURES = ["n", *SUMS]


class _JoinedScore:
    """Scores of texts whose n-grams lie one after the other, beside their figures."""

    def __init__(self, languages: dict):
        self.languages = languages

    def scores(self, rows: pa.Table) -> pa.RecordBatch:
        row, keys, own = (rows.column(c).to_numpy() for c in ("row", "key", "own"))
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        names = [*langs.dictionary.to_pylist(), None]
        code = langs.indices.fill_null(len(names) - 1).to_numpy(zero_copy_only=False)
        new = np.flatnonzero(np.diff(row, prepend=row[0] - 1))
        ids, nats = [], []
        for a, b in zip(new.tolist(), [*new[1:].tolist(), len(row)], strict=True):
            cuts, symbols = self.languages[names[code[a]]]
            figures = (
                [rows.column(f"{c}{k}").slice(a, b - a).to_numpy() for c in FIGURES]
                for k in range(ORDER, 0, -1)
            )
            doc = np.zeros(b - a, np.int64)
            total = nats_without_own(doc, keys[a:b], own[a:b], figures, cuts, symbols)
            ids.append(row[a])
            nats.append(total[0] / own[a:b].sum())
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(nats)], ["row", "nats"])

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            row = batch.column("row").to_numpy()
            last = int(np.searchsorted(row, row[-1]))
            if held and held[-1].column("row")[-1].as_py() != row[0]:
                yield self.scores(pa.Table.from_batches(held))
                held = []
            if last:
                yield self.scores(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
        if held:
            yield self.scores(pa.Table.from_batches(held))


def _scores_by_join(docs: DataFrame, levels: dict[int, DataFrame]) -> DataFrame:
    """(row, nats): each text's own distinct n-grams meet their figures in a join.

    The counts hold every n-gram of `docs`, as they were made from them.
    """
    languages, wide = {}, levels[ORDER].withColumnRenamed("n", f"n{ORDER}")
    for k in range(ORDER, 0, -1):
        times = [F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]
        for lang, *found, size in levels[k].groupBy("lang").agg(*times, F.count("*")).collect():
            languages.setdefault(lang, ({}, size))[0][k] = _discounts(found)
            languages[lang] = languages[lang][0], size
        n, short = F.col("n"), F.col("key").bitwiseAND(F.lit(_mask(k)))
        if k < ORDER:
            level = levels[k].select(F.col("lang").alias("other"), F.col("key").alias("gram"), n.alias(f"n{k}"))
            wide = wide.join(level, F.col("lang").eqNullSafe(F.col("other")) & (short == F.col("gram")))
            wide = wide.drop("other", "gram")
        kinds = [F.count_if(c).alias(f"{name}{k}") for name, c in (("ones", n == 1), ("twos", n == 2), ("more", n > 2))]
        contexts = levels[k].groupBy(F.col("lang").alias("other"), F.shiftright("key", BITS).alias("before"))
        contexts = contexts.agg(F.sum("n").alias(f"total{k}"), *kinds)
        wide = wide.join(contexts, F.col("lang").eqNullSafe(F.col("other")) & (F.shiftright(short, BITS) == F.col("before")))
        wide = wide.drop("other", "before")
    names = {"lang": "other", "key": "gram"}
    wide = staged(wide, "figures").withColumnsRenamed(names)
    own = docs.mapInArrow(_keys_by_row, "row long, lang string, key long, own long")
    found = own.join(wide, F.expr("lang <=> other and key = gram")).drop("other", "gram")
    found = found.repartition("row").sortWithinPartitions("row", "key")
    return found.mapInArrow(_JoinedScore(languages), "row long, nats double")


def _later_copies(docs: DataFrame) -> DataFrame:
    """(row), staged: rows whose text stands in an earlier row of their language, too.

    Texts are told apart by 128 bits.
    """
    digests = [F.xxhash64("text").alias("one"), F.xxhash64(F.lit(1), "text").alias("two")]
    told = docs.select("row", "lang", *digests)
    groups = told.groupBy(F.col("lang").alias("other"), F.col("one").alias("a"), F.col("two").alias("b"))
    groups = groups.agg(F.min("row").alias("first"), F.count("*").alias("copies"))
    groups = sized(staged(groups.where("copies > 1").drop("copies"), "copied"))
    later = told.join(groups, F.expr("lang <=> other and one = a and two = b and row > first"))
    return staged(later.select("row"), "later-copies")


def quality_scores(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    row: str | None = None,
    model_rows: int = MODEL_ROWS,
    mapped_rows: int = MAPPED_ROWS,
) -> DataFrame:
    """One row per document with figures, band and verdict.

    Columns row, doc_id, lang, STATS, base_failed, nats, lower, upper, kept. A null text
    counts as empty and fails the base rules; a null language is a language of its own.
    A language whose texts all fail has no band and keeps nothing. Equal texts count
    once in model and medians, and each row is judged; other columns are not read.
    """
    reach(docs.sparkSession)
    if not row:
        docs, row = numbered_rows(docs.select(*dict.fromkeys([doc, text, lang])), doc)
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    slim = docs.select(
        F.col(row).alias("row"), F.col(doc).alias("doc"), F.col(lang).cast("string").alias("lang"), plain.alias("text")
    )
    later = _later_copies(slim)
    once = slim.join(sized(later), "row", "left_anti").select("lang", "text")
    counts = top_counts(once)
    kind = dict(slim.dtypes)["doc"]
    schema = f"row long, doc {kind}, lang string, chars long, " + ", ".join(f"{c} long" for c in STATS)
    arrays = folder = None
    size = counts.count()
    if 2 * size <= model_rows:
        arrays = docs.sparkSession.sparkContext.broadcast(counted(counts))
        scores = slim.mapInArrow(_Score(arrays), schema + ", nats double")
    elif 2 * size <= mapped_rows:
        models, folder = mapped(counts, size)
        scores = slim.mapInArrow(_Score(models), schema + ", nats double")
    else:
        nats = staged(_scores_by_join(slim, lower_levels(counts)), "scores")
        scores = slim.mapInArrow(_Score(), schema).join(nats, "row", "left")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > int(100 * REPEATED) * F.col("n_words")
    )
    scores = staged(scores.withColumn("base_failed", failed).fillna(0.0, ["nats"]), "scores")
    if arrays:
        arrays.destroy()  # written scores need it no more, and workers drop theirs
    if folder and mounted(docs.sparkSession, folder):
        remove_folder(docs.sparkSession, folder)  # an added file stays for executors to come
    sound = scores.where(~F.col("base_failed")).join(sized(later), "row", "left_anti")
    middle = sound.groupBy("lang").agg(F.percentile(F.round("nats", 3), F.lit(0.5)).alias("middle"))
    middle = F.broadcast(middle.withColumnRenamed("lang", "other"))
    apart = F.abs(F.col("nats") - F.col("middle")) * F.sqrt("chars")
    spread = sound.join(middle, F.expr("lang <=> other")).groupBy("lang", "middle")
    spread = spread.agg(F.percentile(F.round(apart, 2), F.lit(0.5)).alias("apart"))
    least = F.greatest(1.4826 * F.col("apart"), F.lit(LEAST)).alias("spread")
    bands = spread.select(F.col("lang").alias("other"), "middle", least)
    judged = scores.join(F.broadcast(bands), F.expr("lang <=> other"), "left")
    half = F.col("spread") / F.sqrt(F.greatest("chars", F.lit(1)))
    judged = judged.withColumn("lower", F.col("middle") - BELOW * half - MORE)
    judged = judged.withColumn("upper", F.col("middle") + ABOVE * half + MORE)
    within = F.coalesce(F.col("nats").between(F.col("lower"), F.col("upper")), F.lit(False))
    return judged.select(
        "row", F.col("doc").alias("doc_id"), "lang", *STATS, "base_failed",
        "nats", "lower", "upper", (~F.col("base_failed") & within).alias("kept"),
    )


def quality_filter(docs: DataFrame, doc: str = "doc_id", **columns: str) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns."""
    numbered, row = numbered_rows(docs, doc)
    judged = quality_scores(numbered, doc=doc, row=row, **columns)
    rejected = staged(judged.where("not kept").select(F.col("row").alias(row)), "rejected")
    return without_rows(numbered, row, rejected)


@query("op1_quality_rules")
def op1_quality_rules(spark, folder):
    judged = quality_scores(table(spark, folder, "documents"))
    exp = [F.exp(c).alias(n) for c, n in (("nats", "perplexity"), ("lower", "lowest"), ("upper", "highest"))]
    return judged.select("doc_id", *STATS, "base_failed", "kept", "lang", *exp)
