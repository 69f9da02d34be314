import random

import numpy as np
import plain
import pytest
from fieldledger.llm import repeats
from fieldledger.llm.repeats import blind_trie, deep_shallow, repeated_spans


def prefix(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def strings(rng, n):
    base = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 90))) for _ in range(5)]
    return [rng.choice(base)[: rng.randint(0, 90)] + bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 3))) for _ in range(n)]


def test_blind_trie_sorts():
    rng = random.Random(23)
    for n in range(1, 60):
        texts = strings(rng, n)
        order, common = blind_trie(texts)
        assert [texts[i] for i in order] == sorted(texts)
        assert sorted(order) == list(range(n))
        want = [prefix(texts[a], texts[b]) for a, b in zip(order, order[1:], strict=False)]
        assert common[1:] == want


def test_deep_shallow_sorts_within_groups():
    rng = random.Random(24)
    for n in (1, 2, 30, 200):
        texts = strings(rng, n)
        group = np.array([rng.randrange(4) for _ in texts])
        size = np.array([len(t) for t in texts])
        data = np.frombuffer(b"".join(texts) or b"x", np.uint8)
        order, common = deep_shallow(data, np.cumsum(size) - size, size, group)
        keys = [(int(group[i]), texts[i]) for i in order]
        assert keys == sorted(keys)
        for k in range(n):
            new = not k or group[order[k]] != group[order[k - 1]]
            assert common[k] == (-1 if new else prefix(texts[order[k - 1]], texts[order[k]]))


def expected(rows, order):
    seen, out = set(), []
    for k in order:
        raw = (rows[k][1] or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - repeats.LENGTH + 1):
            window = raw[i : i + repeats.LENGTH]
            if window in seen:
                gone[i : i + repeats.LENGTH] = True
            seen.add(window)
        spans = np.flatnonzero(np.diff(gone.astype(int), prepend=0, append=0)).reshape(-1, 2)
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out.append((str(rows[k][0]), len(raw), spans.tolist(), kept))
    return sorted(out)


def found(docs):
    return sorted(
        (str(r.doc), r.n_bytes, [list(x) for x in zip(r.begin or [], r.end or [], strict=True)], bytes(r.kept))
        for r in repeated_spans(docs).collect()
    )


def passages(seed, n):
    rng = random.Random(seed)
    shared = [plain.syllables(rng, k) for k in (20, 30, 60, 25, 40)] + ["xy" * 150, "é" * 200]
    out = []
    for _ in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.5 else plain.syllables(rng, rng.randint(1, 25)) for _ in range(rng.randint(1, 6))]
        out.append(" ".join(p[rng.randint(0, 9) :] for p in parts))
    return out


@pytest.mark.parametrize(("group", "listed"), [(100_000, 16_000_000), (2, 0)])
def test_random_passages(spark, monkeypatch, group, listed):
    monkeypatch.setattr(repeats, "GROUP", group)
    monkeypatch.setattr(repeats, "LISTED", listed)
    rows = [(i * 7 % 101, t, "en") for i, t in enumerate(passages(group % 97, 101))]
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])
    want = expected(rows, order)
    assert sum(bool(r[2]) for r in want) > 40
    assert found(plain.table(spark, rows)) == want


def test_odd_rows(spark):
    rows = plain.odd_rows(random.Random(25))
    got = found(plain.table(spark, rows))
    assert len(got) == len(rows)
    one = {r[0]: r for r in got}
    assert one["1"][1:] == (0, [], b"") and one["2"][1:] == (0, [], b"")
    assert one["11"][2] == [[1, 30_000]]
    assert one["8"][2] == [[0, len(rows[7][1].encode()) - 2]] or len(one["8"][2]) == 1
    assert sum(not r[2] for r in got if r[0] == "10") == 1
    assert found(plain.table(spark, [])) == []
