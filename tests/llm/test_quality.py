import pickle
import random

import numpy as np
import plain
import pytest
from fieldledger.llm import perplexity
from fieldledger.llm.perplexity import ABOVE, BELOW, LEAST, MORE, STATS, base_stats, quality_filter, quality_scores


def test_base_figures():
    rng = random.Random(3)
    texts = ["", " ", "a", "a b c d e a b c d e", "x\nx\n\n \nx", "#|<> *"]
    texts += [plain.syllables(rng, rng.randint(1, 80), 3).replace(" ", rng.choice([" ", "\n", "\t "])) for _ in range(60)]
    texts += ["a b " * 40, " a  b", "x" * 10_000]
    found = list(zip(*(x.tolist() for x in base_stats(texts)), strict=True))
    assert found == [plain.base_figures(t) for t in texts]


def expected(rows):
    figures = BELOW, ABOVE, LEAST, MORE
    found = plain.verdicts([(t or "", lang) for _, t, lang in rows], perplexity.ORDER, *figures)
    return [(*r, *x) for r, x in zip(rows, found, strict=True)]


def test_verdicts_by_both_ways(spark):
    rng = random.Random(5)
    rows = plain.odd_rows(rng) + [(100 + i, t, "en") for i, t in enumerate(plain.random_texts(6, 60))]
    docs = plain.table(spark, rows)
    plainly = expected(rows)
    want = sorted((str(r[0]), *r[3], r[4], r[6]) for r in plainly)
    nats = sorted((str(r[0]), round(r[5], 5)) for r in plainly)
    for size in (perplexity.MODEL_ROWS, 0):
        found = quality_scores(docs, model_rows=size).collect()
        got = sorted((str(r.doc_id), *(r[c] for c in STATS), r.base_failed, r.kept) for r in found)
        assert got == want
        scored = sorted((str(r.doc_id), round(r.nats, 5)) for r in found)
        assert all(abs(x[1] - y[1]) < 1e-4 for x, y in zip(scored, nats, strict=True))
    kept = quality_filter(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(r[0] for r in want if r[-1])


def test_foreign_text_is_rejected_and_no_other(spark):
    rng = random.Random(16)
    rows = [(i, plain.syllables(rng, rng.randint(12, 120)), "en") for i in range(250)]
    odd = [chr(rng.randint(200, 900)) + " " * (rng.random() < 0.2) for _ in range(400)]
    rows.append((300, "".join(odd), "en"))
    found = quality_scores(plain.table(spark, rows)).where("not base_failed").collect()
    assert [r.doc_id for r in found if not r.kept] == [300]
    assert len(found) > 200


def test_copies_of_a_sound_text_are_kept(spark):
    rng = random.Random(17)
    rows = [(i, plain.syllables(rng, rng.randint(12, 120)), "en") for i in range(200)]
    copied = plain.syllables(rng, 200)
    rows += [(1000 + i, copied, "en") for i in range(100)]
    for size in (perplexity.MODEL_ROWS, 0):
        found = quality_scores(plain.table(spark, rows), model_rows=size)
        assert found.where("doc_id >= 1000 and not base_failed").count() == 100
        assert found.where("doc_id >= 1000 and kept").count() == 100


def test_scores_leave_out_what_the_text_brought(spark):
    texts = [t for t in dict.fromkeys(plain.random_texts(4, 30)) if t] + ["😀ж中" * 5]
    full = plain.KneserNey(texts, perplexity.ORDER)
    docs = plain.table(spark, [(i, t, "en") for i, t in enumerate(texts + texts[:2])])
    for size in (perplexity.MODEL_ROWS, 0):
        for r in quality_scores(docs, model_rows=size).collect():
            text = (texts + texts[:2])[r.doc_id]
            others = plain.KneserNey([t for t in texts if t != text], perplexity.ORDER)
            others.cuts = full.cuts
            assert abs(r.nats - others.nats(text)) < 1e-6


def test_gibberish_is_rejected_in_any_amount(spark):
    rng = random.Random(18)
    rows = [(i, plain.syllables(rng, rng.randint(100, 400)), "en") for i in range(250)]
    kinds = ["abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz0123456789", "αβγδεζηθικλμνξοπρστυφχψω"]
    for amount in (1, 20):
        junk = ["".join(rng.choice(k + "  " * 2) for _ in range(n)) for k in kinds for n in (1500, 6000) for _ in range(amount)]
        odd = [(1000 + i, t, "en") for i, t in enumerate(junk)]
        found = quality_scores(plain.table(spark, rows + odd)).where("not base_failed")
        assert found.where("doc_id >= 1000").count() == len(junk)
        assert found.where("doc_id >= 1000 and kept").count() == 0
        assert found.where("doc_id < 1000 and not kept").count() <= 2


def test_empty_table(spark):
    assert quality_scores(plain.table(spark, [])).count() == 0


def mixed_docs(spark):
    rng = random.Random(21)
    rows = [(i, t, rng.choice(["en", "de", None])) for i, t in enumerate(plain.random_texts(9, 90))]
    rows += [(1000 + i, plain.syllables(rng, rng.randint(12, 90)), "en") for i in range(60)]
    return plain.table(spark, rows + [(2000, "😀ж中" * 9, "de"), (2001, rows[3][1], rows[3][2])])


def judged(docs, **bounds):
    found = quality_scores(docs, **bounds).drop("row").collect()
    return sorted([str(x) for x in r[:-4]] + [round(r[-4], 9), str(r[-1])] for r in found)


@pytest.mark.parametrize("block", [3, 100, 1 << 21])
def test_files_of_a_model_hold_its_arrays(tmp_path, monkeypatch, block):
    monkeypatch.setattr(perplexity, "BLOCK", block)
    keys, n = np.unique(perplexity.ngrams(plain.random_texts(9, 6))[0], return_counts=True)
    n[5] = 1 << 33
    files, counted = perplexity._Files(str(tmp_path), 0), perplexity.Counted(keys, n)
    for part in (slice(0, 11), slice(11, None)):
        files.append(perplexity.ORDER, "key", keys[part])
        files.append(perplexity.ORDER, "n", n[part])
    cuts, symbols = files.finish()
    mapped = pickle.loads(pickle.dumps(perplexity.Mapped(str(tmp_path), False, files.kinds, cuts, symbols)))
    assert (mapped.cuts, mapped.symbols) == (counted.cuts, counted.symbols)
    for x, y in zip(mapped.figures(keys[::2]), counted.figures(keys[::2]), strict=True):
        assert all((a == b).all() for a, b in zip(x, y, strict=True))


@pytest.mark.parametrize("mount", [True, False])
def test_a_large_model_is_mapped_and_joins_no_rows_of_texts(spark, monkeypatch, mount):
    docs = mixed_docs(spark)
    sent = judged(docs)
    monkeypatch.delattr(perplexity, "_scores_by_join")
    if not mount:
        monkeypatch.setattr(perplexity, "mounted", lambda *x: None)
    assert judged(docs, model_rows=0) == sent


def test_a_model_beyond_its_files_bound_is_joined(spark):
    docs = mixed_docs(spark)
    assert judged(docs, model_rows=0, mapped_rows=0) == judged(docs)
