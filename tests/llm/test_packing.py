import random
import zlib

import numpy as np
import plain
import public_tokenizers
from fieldledger.llm.packing import packed_pieces, sequences, windows
from fieldledger.llm.tokens import VOCABULARY, Encoder
from fieldledger.scratch import staged
from tokenizers import Tokenizer

PATH = public_tokenizers.path(VOCABULARY)


def test_ids_are_the_tokenizers():
    rng = random.Random(12)
    odd = "a1 '\n\t  é中😀\x00\x1c\x85²Ⅷ_<|endoftext|>'ll're 's"
    texts = ["", " ", "it's  \n\n a's", "x<|endoftext|>y", "\x1c\x1d a", "áb ²³ Ⅷ"]
    texts += ["Hi, a. b, hi. Été, naïve; x1, it's. foo,, (a). a! . , ,a", "a. a, b"] * 2
    texts += ["".join(rng.choice(odd + "ab.,;!") for _ in range(rng.randint(1, 40))) for _ in range(300)]
    texts += ["".join(rng.choice(odd) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    mine = Encoder(PATH)(texts)
    theirs = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in mine] == [x.ids for x in theirs]


def check(spark, rows, length):
    tokenizer = Tokenizer.from_file(PATH)
    ids = {}
    for i, t, _ in rows:
        ids.setdefault(str(i), []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])
    cut = staged(windows(plain.table(spark, rows), length=length), "windows")
    packed = sorted(sequences(cut, length).collect(), key=lambda r: r.sequence_id)
    total = sum(len(x) for y in ids.values() for x in y)
    assert [r.sequence_id for r in packed] == list(range(-(-total // length)))
    found = {}
    for n, r in enumerate(packed):
        flat = np.frombuffer(r.ids, "<u4")
        assert len(flat) == (length if n + 1 < len(packed) else total - n * length)
        assert [p.offset for p in r.pieces] == list(np.cumsum([0] + [p.length for p in r.pieces])[:-1])
        for p in r.pieces:
            part = flat[p.offset : p.offset + p.length]
            assert len(part) == p.length
            found.setdefault((str(p.doc), p.tokens), []).extend(part.tolist())
    for key, parts in ids.items():
        for one in parts:
            assert len(one) in [n for k, n in found if k == key]
    assert sorted(sum(found.values(), [])) == sorted(i for x in ids.values() for y in x for i in y)
    single = {k: v[0] for k, v in ids.items() if len(v) == 1}
    for k, one in single.items():
        assert found[k, len(one)] == one


def test_round_trip(spark):
    rows = [(i, t, "en") for i, t in enumerate(plain.random_texts(13, 90))]
    check(spark, rows, 64)


def test_odd_rows(spark):
    check(spark, plain.odd_rows(random.Random(14)), 2048)


def test_pieces_carry_checksums(spark):
    rows = [(i, t, "en") for i, t in enumerate(plain.random_texts(15, 40))]
    tokenizer = Tokenizer.from_file(PATH)
    for p in packed_pieces(plain.table(spark, rows), length=32).collect():
        own = np.array(tokenizer.encode(rows[p.doc_id][1]).ids + [1], "<u4")
        part = own[p.start : p.start + p.length]
        assert (p.doc_tokens, p.ids_crc32) == (len(own), zlib.crc32(part.tobytes()))


def test_empty_table(spark):
    assert packed_pieces(plain.table(spark, [])).count() == 0
