import random
import zlib

import corpus_pipeline
import numpy as np
import plain
import public_tokenizers
from fieldledger.llm.perplexity import ABOVE, BELOW, LEAST, MORE, ORDER
from fieldledger.llm.pii import EXAMPLE_KEY, pseudonymised
from fieldledger.llm.queries import QUERIES
from fieldledger.llm.tokens import VOCABULARY
from test_exact import normal
from tokenizers import Tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def sound(rows):
    """The documents that the quality rules keep, by plain models."""
    found = plain.verdicts([(r.text, r.lang) for r in rows], ORDER, BELOW, ABOVE, LEAST, MORE)
    kept = [r for r, x in zip(rows, found, strict=True) if x[-1]]
    return sorted(kept, key=lambda r: r.doc_id)


def test_against_a_plain_version(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    kept, seen = [], set()
    for r in sound(rows):
        if normal(r.text) not in seen:
            seen.add(normal(r.text))
            kept.append(r)
    sets = [plain.grams(r.text, corpus_pipeline.WORDS) for r in kept]
    root = plain.components(plain.linked(sets, corpus_pipeline.SHARE), range(len(kept)))
    kept = [r for i, r in enumerate(kept) if root[i] == i]
    texts = {r.doc_id: pseudonymised(r.text, EXAMPLE_KEY)[0] for r in kept}
    tokenizer = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    ids = {i: np.array(tokenizer.encode(t).ids + [1], "<u4") for i, t in texts.items()}

    found = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in found} == set(texts)
    assert len(texts) < len(rows)
    for r in found:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert (r.doc_tokens, r.ids_crc32) == (len(ids[r.doc_id]), zlib.crc32(part.tobytes()))
    assert sum(r.length for r in found) == sum(map(len, ids.values()))


def test_stages_return_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(20), folder).columns == COLUMNS, name


def test_results_that_are_read_late(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60)
    made = [stage(spark, docs, folder) for _, stage in corpus_pipeline.STAGES]
    assert all(df.count() > 0 for df in made)


def test_odd_rows_and_empty_tables(spark, folder):
    rows = plain.odd_rows(random.Random(41)) + [(100 + i, t, "en") for i, t in enumerate(plain.random_texts(9, 30))]
    docs = plain.table(spark, rows)
    empty = plain.table(spark, [])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, folder)
        assert found.columns == docs.columns and 0 < found.count() <= len(rows), name
        assert stage(spark, empty, folder).count() == 0, name
    ids = [(str(r.doc_id), r.start, r.length) for r in corpus_pipeline.packed(spark, docs, folder).collect()]
    assert {i for i, *_ in ids} == {str(i) for i, *_ in rows}
    assert corpus_pipeline.packed(spark, empty, folder).count() == 0


def test_all_operators_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
