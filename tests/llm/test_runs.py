import hashlib
import random
import zlib

import numpy as np
import plain
from fieldledger.llm.queries import QUERIES
from fieldledger.llm.runs import Grammar, periodic_runs, word_ids, word_runs


def plain_runs(words):
    """All runs, by comparing words of every distance."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        start = None
        for i in range(n - q + 1):
            same = i < n - q and words[i] == words[i + q]
            if same and start is None:
                start = i
            if not same and start is not None:
                end = i + q
                if end - start >= max(6, 4 * q):
                    best.setdefault((start, end), q)
                start = None
    return sorted((s, e - s, q) for (s, e), q in best.items())


def found(texts):
    split, ids, text = word_ids([t.encode() for t in texts])
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    out = [[] for _ in texts]
    for s, e, q in word_runs(ids, text).tolist():
        out[text[s]].append((s - int(first[text[s]]), e - s, q))
    return out


def texts(rng):
    out = ["", "a", "a " * 5, "a " * 6, "a b " * 4, "a b " * 3 + "a", "a b " * 3 + "a b a", "x" * 50]
    out += ["a b a c " * 5 + "a b", "a a b " * 9 + "a a", "a " * 3000, "a b c d e " * 200]
    fib = ["a", "a b"]
    while len(fib) < 14:
        fib.append(fib[-1] + " " + fib[-2])
    odd = ["a"]
    while len(odd) < 512:
        odd += ["b" if w == "a" else "a" for w in odd]
    out += [fib[-1], " ".join(odd), " ".join(odd * 5)]
    for _ in range(250):
        letters = "abcdefgh"[: rng.randint(1, 8)]
        words = []
        while len(words) < rng.choice([5, 20, 60, 200]):
            unit = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
            words += (unit * rng.randint(1, 9))[: rng.randint(1, 70)]
        out.append(" ".join(words))
    return out


def test_runs_are_those_of_all_distances():
    given = texts(random.Random(5))
    for t, runs in zip(given, found(given), strict=True):
        assert runs == plain_runs(t.split()), t


def test_grammar_gives_the_words_back():
    split, ids, text = word_ids([t.encode() for t in texts(random.Random(6))])
    g = Grammar(ids.copy(), text)

    def words(s):
        return [s] if s < g.words else words(g.left[s]) + words(g.right[s])

    assert [w for s in g.rest for w in words(s)] == ids.tolist()
    for s in range(g.words, len(g.left)):
        assert ids[g.place[s] : g.place[s] + g.size[s]].tolist() == words(s)
    pairs, last = {}, None
    for i in range(len(g.rest) - 1):
        pair = (int(g.rest[i]), int(g.rest[i + 1])) if g.text[i] == g.text[i + 1] else None
        if pair and not (pair == last and pair[0] == pair[1]):
            assert pair not in pairs or pairs[pair] == i - 1
            pairs[pair] = i
        last = pair


def planted(doc, text):
    words = plain.word_list(text)
    h = zlib.crc32(str(doc).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_against_all_distances(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, folder).collect()}
    assert len(rows) == len(docs)
    total = 0
    for d in docs:
        words = planted(d.doc_id, d.text)
        runs, r = plain_runs(words), rows[d.doc_id]
        total += len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(left.encode()).hexdigest()
    assert total > 10


def test_odd_rows(spark):
    rows = [*plain.odd_rows(random.Random(8)), (20, "é é " * 9, "en"), (21, "a " * 200_000, "en")]
    got = periodic_runs(plain.table(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (1, 2, 3):
            assert (r.n_words, r.runs, r.collapsed) == (0, [], "")
        if r.doc_id == 20:
            assert [tuple(x) for x in r.runs] == [(0, 9, 1)] and r.collapsed == "é é"
        if r.doc_id == 21:
            assert [tuple(x) for x in r.runs] == [(0, 200_000, 1)] and r.collapsed == "a"
    assert periodic_runs(plain.table(spark, [])).count() == 0
