"""SentencePiece encoding and decoding: a batched Viterbi search in numpy.

A text is cut where a space mark follows another character, which no piece spans, and
each distinct word is encoded once. Words of equal length advance together: at every
position the hashes of all substrings that end there are looked up among the sorted
hashes of the pieces, the best score of each word is a maximum over their starts, and
the start is kept as a back pointer. Where no piece of one character fits, an unknown
character costs more than any piece and becomes its bytes. Of equal scores, the one
with the longest last piece wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import SLICE_BYTES, give_back, slices, text_or_empty
from fieldledger.llm.registry import query, reach, table
from fieldledger.llm.tokens import Gathered
from fieldledger.llm.words import _STEP, _power, code_points, mixed

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"

#: How much an unknown character costs beyond the worst piece.
PENALTY = 10.0

#: Substrings that are looked up at once.
PROBES = 2_000_000

_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def _rolling(codes: np.ndarray) -> np.ndarray:
    """Running polynomials over the rows of `codes`, with a leading 0."""
    sums = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    np.cumsum(mixed(codes + np.uint64(1)) * _power(_STEP, codes.shape[1]), axis=1, out=sums[:, 1:])
    return sums


class Pieces:
    """The pieces of a model, by sorted hash, and the search for the best ones of a word.

    `found` are (piece, score) for all that may be matched; ids of the 256 byte pieces
    stand in `byte`, and `unknown` is used without them.
    """

    def __init__(self, found: dict[str, tuple[int, float]], byte: list[int], unknown: int = 0):
        names = list(found)
        self.byte, self.unknown = byte, unknown
        self.longest = max(map(len, names), default=1)
        self.whole = any(re.search(f"[^{SPACE}]{SPACE}", n) for n in names)
        keys = np.array([self._key(n) for n in names], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ids = np.array([found[n][0] for n in names], np.int64)[order]
        self.scores = np.array([found[n][1] for n in names], np.float64)[order]
        self.worst = float(self.scores.min()) - PENALTY if names else -PENALTY

    @staticmethod
    def _key(piece: str) -> int:
        codes = code_points(piece)[None, :].astype(np.uint64)
        return int(mixed(_rolling(codes)[:, -1] + mixed(np.array([len(piece)], np.uint64)))[0])

    def words(self, text: str) -> list[str]:
        marked = SPACE + text.replace(" ", SPACE)
        return [marked] if self.whole else re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", marked)

    def encode(self, words: list[str]) -> list[list[int]]:
        """The ids of each word; words of one length go through the search together."""
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        out: list[list[int]] = [[] for _ in words]
        for n, members in by_length.items():
            step = max(1, PROBES // (n * min(n, self.longest)))
            for a in range(0, len(members), step):
                part = members[a : a + step]
                for i, ids in zip(part, self._search([words[i] for i in part], n), strict=True):
                    out[i] = ids
        return out

    def _search(self, words: list[str], n: int) -> list[list[int]]:
        rows = len(words)
        codes = code_points("".join(words)).reshape(rows, n).astype(np.uint64)
        sums, most = _rolling(codes), min(n, self.longest)
        inverse = _power(np.uint64(pow(int(_STEP), -1, 1 << 64)), n + 1)
        sizes = mixed(np.arange(n + 1, dtype=np.uint64))
        best = np.full((rows, n + 1), -np.inf)
        best[:, 0] = 0.0
        start = np.zeros((rows, n + 1), np.int64)
        piece = np.full((rows, n + 1), -1, np.int64)
        every = np.arange(rows)
        for end in range(1, n + 1):
            first = max(0, end - most)
            begin = np.arange(first, end)
            keys = (sums[:, end : end + 1] - sums[:, first:end]) * inverse[begin]
            keys = mixed(keys + sizes[end - begin])
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            score = np.where(hit, self.scores[at], -np.inf)
            score[:, -1] = np.where(hit[:, -1], score[:, -1], self.worst)
            total = best[:, first:end] + score
            chosen = np.argmax(total, axis=1)
            best[:, end] = total[every, chosen]
            start[:, end] = first + chosen
            piece[:, end] = np.where(hit[every, chosen], self.ids[at[every, chosen]], -1)
        return [self._back(w, s, p) for w, s, p in zip(words, start.tolist(), piece.tolist(), strict=True)]

    def _back(self, word: str, start: list[int], piece: list[int]) -> list[int]:
        out, end = [], len(word)
        while end:
            begin = start[end]
            if piece[end] >= 0:
                out.append(piece[end])
            elif self.byte:
                raw = word[begin:end].encode("utf-8", "surrogatepass")
                out += [self.byte[b] for b in reversed(raw)]
            else:
                out.append(self.unknown)
            end = begin
        return out[::-1]


class PieceEncoder(Gathered):
    """Ids of texts with a SentencePiece model, and texts of ids."""

    table_bytes = 150_000_000

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        byte = [i for i in range(size) if model.is_byte(i)]
        other = {*byte, *(i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
        byte = sorted(byte, key=lambda i: int(_BYTE.fullmatch(names[i])[1], 16))
        found = {names[i]: (i, model.get_score(i)) for i in range(size) if i not in other}
        self.model = Pieces(found, byte if len(byte) == 256 else [], model.unk_id())
        self.bytes = [b"" if i in other else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        for value, i in enumerate(byte):
            self.bytes[i] = bytes([value])
        super().__init__()

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        if self.model.whole or "  " in text or SPACE in text or text[0] == " ":
            return [" " + w for w in self.model.words(text)]
        return text.split(" ")

    def learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode([p.replace(" ", SPACE) for p in pieces])
        return np.fromiter(chain.from_iterable(found), np.uint32), np.array(list(map(len, found)))

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join([self.bytes[i] for i in ids.tolist()])
        return raw.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


class _Encode:
    def __init__(self, path: str):
        self.path = path

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = piece_encoder(self.path)
        for batch in slices(batches, "text"):
            found = encode(batch.column("text").to_pylist())
            offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), ids], ["doc", "ids"])
        encode.clear()
        give_back()


class _Decode:
    """Texts of ids; with `encode`, texts are encoded first, in the same pass."""

    def __init__(self, path: str, encode: bool = False):
        self.path, self.encode = path, encode

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = piece_encoder(self.path).decode
        for batch in _Encode(self.path)(batches) if self.encode else batches:
            for part in _id_slices(batch):
                lists = part.column("ids")
                ids, many = lists.flatten().to_numpy(), pc.fill_null(pc.list_value_length(lists), 0)
                ends = np.concatenate(([0], np.cumsum(many.to_numpy(zero_copy_only=False))))
                texts = [decode(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                columns = [part.column("doc"), lists, pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "ids", "text"])


def _id_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about `SLICE_BYTES` ids in all."""
    many = pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(many) - many) // SLICE_BYTES
    for at in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(group)) + 1):
        if len(at):
            yield batch.slice(int(at[0]), len(at))


def encoded(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", path: str | None = None
) -> DataFrame:
    """(doc, ids) for every row. A null or empty text has no ids; rows may repeat; an empty
    table gives an empty result; other columns are not read."""
    path = path or public_tokenizers.path(VOCABULARY)
    reach(docs.sparkSession)
    slim = docs.select(F.col(doc).alias("doc"), text_or_empty(text).alias("text"))
    kind = slim.schema["doc"].dataType.simpleString()
    return slim.mapInArrow(_Encode(path), f"doc {kind}, ids array<int>")


def decoded(ids: DataFrame, path: str | None = None) -> DataFrame:
    """(doc, ids, text) from (doc, ids). Null ids give an empty text."""
    path = path or public_tokenizers.path(VOCABULARY)
    kind = ids.schema["doc"].dataType.simpleString()
    return ids.select("doc", "ids").mapInArrow(
        _Decode(path), f"doc {kind}, ids array<int>, text string"
    )


def round_trip(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", path: str | None = None
) -> DataFrame:
    """(doc, ids, text): `decoded(encoded(docs))` in one pass, so that a task has one worker
    and one table of pieces. Odd rows are treated as these two do."""
    path = path or public_tokenizers.path(VOCABULARY)
    reach(docs.sparkSession)
    slim = docs.select(F.col(doc).alias("doc"), text_or_empty(text).alias("text"))
    kind = slim.schema["doc"].dataType.simpleString()
    return slim.mapInArrow(_Decode(path, encode=True), f"doc {kind}, ids array<int>, text string")


@query("op2_sentencepiece")
def op2_sentencepiece(spark, folder):
    found = round_trip(table(spark, folder, "documents"))
    joined = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return found.select(
        F.col("doc").alias("doc_id"),
        F.size("ids").cast("long").alias("n_ids"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
