import random

import plain
import public_tokenizers
import sentencepiece
from fieldledger.llm.pieces import PENALTY, SPACE, VOCABULARY, Pieces, decoded, encoded, piece_encoder

PATH = public_tokenizers.path(VOCABULARY)


def best(word, found, worst):
    """Score and pieces of the best cut, by a plain search; of equals, the longest last piece."""
    at = [(0.0, [])]
    for end in range(1, len(word) + 1):
        options = []
        for start in range(end):
            piece = word[start:end]
            score = found[piece][1] if piece in found else worst if end - start == 1 else None
            if score is not None:
                options.append((at[start][0] + score, -start, [*at[start][1], piece]))
        score, _, pieces = max(options)
        at.append((score, pieces))
    return at[-1]


def test_search_against_a_plain_one():
    rng = random.Random(17)
    names = {"".join(rng.choice("abc" + SPACE) for _ in range(rng.randint(1, 4))) for _ in range(60)}
    found = {n: (i, float(-rng.randint(0, 9))) for i, n in enumerate(sorted(names))}
    model = Pieces(found, list(range(1000, 1256)))
    words = ["".join(rng.choice("abcdé" + SPACE) for _ in range(rng.randint(1, 12))) for _ in range(400)]
    for word, ids in zip(words, model.encode(words), strict=True):
        _, pieces = best(word, found, min(s for _, s in found.values()) - PENALTY)
        want = [i for p in pieces for i in ([found[p][0]] if p in found else [1000 + b for b in p.encode()])]
        assert ids == want


def test_scores_of_the_public_model():
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(18)
    texts = [plain.syllables(rng, 12) for _ in range(40)] + ["the of x", "a😀b", "\x00\n"]
    pieces = piece_encoder(PATH).model
    found = {model.id_to_piece(i): (i, model.get_score(i)) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    words = sorted({w for t in texts for w in pieces.words(t)})
    for word, ids in zip(words, pieces.encode(words), strict=True):
        _, parts = best(word, found, pieces.worst)
        assert [i for i in ids if not model.is_byte(i)] == [found[p][0] for p in parts if p in found]


def test_round_trip_of_odd_rows(spark):
    rows = plain.odd_rows(random.Random(19))
    rows += [(50 + i, t, "en") for i, t in enumerate(plain.random_texts(20, 40))]
    found = decoded(encoded(plain.table(spark, rows))).collect()
    assert sorted((str(r.doc), r.text) for r in found) == sorted((str(i), t or "") for i, t, _ in rows)
    assert all(not r.ids for r in found if not r.text)
    assert decoded(encoded(plain.table(spark, []))).count() == 0
