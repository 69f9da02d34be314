"""Token ids of many texts with a public byte-level BPE tokenizer.

Texts are cut before single spaces, where the tokenizer's own pattern cuts as well, or
by that pattern where spaces stand together. Each distinct piece is encoded once, as merges
never cross such cuts, by the tokenizer's merges read as ranks. What it returned is held in one flat
array, and a text's ids are gathered from it.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import regex
import tiktoken

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

VOCABULARY = "byte_bpe_50k.json"

#: What Python adds to the bytes of a piece.
EXTRA = 200


class _Places(dict):
    """Numbers keys in the order in which they are first asked for, and lists the new ones."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = at = len(self)
        self.new.append(key)
        return at


class Gathered:
    """Ids of texts, gathered from those of their distinct pieces.

    Distinct pieces and their ids are held up to `table_bytes`; then the table starts anew.

    `split` cuts a text into keys, `learn` gives the ids of pieces not seen before,
    all in one array, and how many each has. Key `x` is the piece " x", and key " x" the piece "x", so that a text cut at single
    spaces is its own list of keys but for the first one.
    """

    table_bytes = 60_000_000

    def __init__(self):
        self.clear()

    def split(self, text: str) -> list[str]:
        raise NotImplementedError

    def learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def clear(self) -> None:
        """Starts the table anew, as a task does at its end: a worker outlives its task."""
        self.known, self.held = _Places(), 0
        self.flat, self.start = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _extend(self, keys: list[str]) -> None:
        flat, sizes = self.learn([k[1:] if k[:1] == " " else " " + k for k in keys])
        self.start = np.concatenate((self.start, np.cumsum(sizes) + len(self.flat)))
        self.flat = np.concatenate((self.flat, flat))
        self.held += EXTRA * len(keys) + sum(map(len, keys)) + flat.nbytes

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if self.held > self.table_bytes:
            self.clear()
        split = list(map(self.split, texts))
        places = map(self.known.__getitem__, chain.from_iterable(split))
        flat = np.fromiter(places, np.int64, sum(map(len, split)))
        if new := self.known.new:
            self.known.new = []
            self._extend(new)
        begin, sizes = self.start[flat], self.start[flat + 1] - self.start[flat]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(begin - (ends - sizes), sizes)]
        cuts = np.cumsum([0, *map(len, split)])
        upto = np.concatenate(([0], ends))[cuts]
        return [ids[a:b] for a, b in zip(upto[:-1], upto[1:], strict=True)]


def _letter_bytes() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: visible characters of
    Latin-1 stand for themselves, letters from U+0100 on for the other bytes, in order."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    other = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(other)}


def ranked_encoding(tokenizer: Tokenizer, pattern: str) -> tiktoken.Encoding | None:
    """The tokenizer's merges as ranks, which encode a piece several times as fast.

    None where the file is not one of bytes whose ids are in the order of its merges.
    """
    told = json.loads(tokenizer.to_str())
    letters, merges = _letter_bytes(), told["model"].get("merges", [])
    vocabulary = told["model"].get("vocab", {})
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
    order = [vocabulary[a + b] for a, b in pairs] if told["normalizer"] is None else []
    ranks = {t: i for t, i in vocabulary.items() if set(t) <= letters.keys()}
    ranks = {bytes(map(letters.__getitem__, t)): i for t, i in ranks.items()}
    if not order or order != sorted(set(order)) or any(bytes([b]) not in ranks for b in range(256)):
        return None
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Encoder(Gathered):
    """Encodes like `Tokenizer.encode(text, add_special_tokens=False)`.

    A text that holds a special token's string is given to the tokenizer whole.
    """

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        self.tokenizer = Tokenizer.from_file(path)
        self.pattern = regex.compile(pattern)
        self.marks = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ranked = ranked_encoding(self.tokenizer, pattern)
        super().__init__()

    def split(self, text: str) -> list[str]:
        if any(m in text for m in self.marks):
            return [" " + text]
        if "  " in text:
            pieces = self.pattern.findall(text)
            return [p[1:] if p[0] == " " and " " not in p[1:] else " " + p for p in pieces]
        keys = text.split(" ")
        keys[0] = " " + keys[0]
        return keys

    def learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = list(map(self._ids, pieces))
        return np.fromiter(chain.from_iterable(found), np.uint32), np.array(list(map(len, found)))

    def _ids(self, piece: str) -> list[int]:
        if self.ranked is None or any(m in piece for m in self.marks):
            return self.tokenizer.encode(piece, add_special_tokens=False).ids
        return self.ranked.encode_ordinary(piece)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
