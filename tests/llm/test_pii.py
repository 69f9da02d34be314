import datetime
import random
import re

import plain
from fieldledger.llm.pii import EXAMPLE_KEY, KINDS, luhn_sum, permuted, pseudonymise, pseudonymised

VALUES = {
    "email": ["hnp.46@mail3.example.com", "A.b-c@x.org"],
    "ip": ["16.195.23.156", "255.0.0.1"],
    "iban": ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"],
    "ssn": ["123-45-6789"],
    "date": ["1984-02-29", "31/12/1999", "12/31/1999", "31.12.1999", "2001/01/01", "3/7/2020", "12/7/2020", "2024-5-30", "31.1.1999", "1/30/2001"],
    "phone": ["+1 (269) 555-3296", "(543) 555-9258", "+49 30 1234 5678", "212-555-0100", "+1 (017) 155-7713", "+442079460958", "+4930123456", "1-800-555-1234", "1 (212) 555-0100"],
    "card": ["4349000490986231", "4111 1111 1111 1111", "3782-822463-10005"],
}
LEFT = ["256.1.1.1", "112-555-0100", "1.2.3.4.5", "000-12-3456", "30.02.2001", "13/13/2000", "1850-01-01", "4349000490986232", "0000000000000000", "x@y", "password=135299847ac0e0f0dc", "GB82WEST12345698765433", "12345678901234567890123", "v1.2.3"]


def test_permutation_of_small_ranges():
    for size in (1, 2, 3, 10, 97, 1000):
        image = [permuted(b"k", "t", i, size) for i in range(size)]
        assert sorted(image) == list(range(size))
        assert [permuted(b"k", "t", i, size, back=True) for i in image] == list(range(size))
    big = [permuted(b"k", "t", i, 10**15) for i in range(50)]
    assert len(set(big)) == 50 and big != [permuted(b"other", "t", i, 10**15) for i in range(50)]


def test_values_keep_their_format_and_are_linked():
    for kind, values in VALUES.items():
        for value in values:
            one, counts = pseudonymised(f"a {value}, b", EXAMPLE_KEY)
            two, _ = pseudonymised(f"other text {value}.", EXAMPLE_KEY)
            new = one[2:-3]
            assert counts == dict.fromkeys(KINDS, 0) | {kind: 1}, value
            assert new != value and two == f"other text {new}."
            assert re.sub("[0-9]", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", new))).count("0") == sum(c.isdigit() for c in value) or kind == "ip"
            assert pseudonymised(one, EXAMPLE_KEY, back=True)[0] == f"a {value}, b"
            if kind == "card":
                assert luhn_sum(re.sub(r"\D", "", new)) % 10 == 0
            if kind != "ip":
                assert len(new) == len(value)


def test_what_is_not_valid_stays():
    for text in LEFT:
        assert pseudonymised(text, EXAMPLE_KEY) == (text, dict.fromkeys(KINDS, 0)), text


def test_whole_addresses_whatever_their_length():
    for n in (63, 64, 65, 80, 5000):
        for letters in ("a", "aB3"):
            local = (letters * n)[:n]
            done, counts = pseudonymised(f"x {local}.z@example.com y", EXAMPLE_KEY)
            new = done[2 : -len("@example.com y")]
            assert counts["email"] == 1 and len(new) == n + 2 and new[-2] == "."
            for i in range(0, n, 64):
                assert new[i : i + 64] != local[i : i + 64]
            assert pseudonymised(done, EXAMPLE_KEY, back=True)[0] == f"x {local}.z@example.com y"
    many = "a" * 200_000 + " b@c.de " + "@" * 1000 + "x@" * 20_000
    assert pseudonymised(many, EXAMPLE_KEY)[1]["email"] == 1


def test_dates_of_timestamps_are_the_same_dates():
    for day in ("2024-05-01", "1999-12-31"):
        alone = pseudonymised(day, EXAMPLE_KEY)[0]
        stamp, counts = pseudonymised(f"at {day}T12:30:00Z.", EXAMPLE_KEY)
        assert stamp == f"at {alone}T12:30:00Z." and counts["date"] == 1
    assert pseudonymised("2024-05-01Tx", EXAMPLE_KEY)[1]["date"] == 0


def test_short_dates_are_a_permutation_of_their_forms():
    days = [datetime.date(2019, 1, 1) + datetime.timedelta(i) for i in range(400)]
    for form in ("{m}/{d}/{y}", "{y}-{m}-{d}", "{d}.{m}.{y}", "{d}/{m}/{y}"):
        texts = {form.format(y=d.year, m=d.month, d=d.day) for d in days}
        image = {t: pseudonymised(t, b"k")[0] for t in texts}
        assert len(set(image.values())) == len(texts)
        for t, new in image.items():
            assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", t)
            assert pseudonymised(new, b"k", back=True)[0] == t


def test_column_of_counts_that_is_there_already(spark):
    docs = spark.createDataFrame([("x@y.de", 5, 1)], "text string, found int, doc_id long")
    row = pseudonymise(docs, EXAMPLE_KEY, counts="found").first()
    assert list(row.asDict()) == ["text", "found", "doc_id"] and row.found.email == 1 and row.doc_id == 1


def test_neighbours_are_found():
    text = "+1 (269) 555-3296 4524132264652876 12 4111 1111 1111 1111 99"
    assert {k: n for k, n in pseudonymised(text, b"k")[1].items() if n} == {"phone": 1, "card": 2}


def test_dates_are_a_permutation():
    for form in ("%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y"):
        days = [datetime.date(1990, 1, 1) + datetime.timedelta(i) for i in range(400)]
        texts = [d.strftime(form) for d in days]
        image = [pseudonymised(t, b"k")[0] for t in texts]
        assert len(set(image)) == len(set(texts))


def test_odd_rows(spark):
    text = " ; ".join(v for values in VALUES.values() for v in values)
    rows = [*plain.odd_rows(random.Random(30)), (77, text, "en"), (78, text, None)]
    docs = plain.table(spark, rows)
    found = pseudonymise(docs, EXAMPLE_KEY, counts="found")
    assert found.columns == [*docs.columns, "found"]
    got = sorted((str(r.doc_id), str(r.text), str(r.lang)) for r in found.collect())
    want = [None if t is None else pseudonymised(t, EXAMPLE_KEY)[0] for _, t, _ in rows]
    assert got == sorted((str(i), str(w), str(lang)) for (i, _, lang), w in zip(rows, want, strict=True))
    assert {r.found.card for r in found.where("doc_id > 70").collect()} == {3}
    assert pseudonymise(docs, EXAMPLE_KEY).schema == docs.schema
    assert pseudonymise(plain.table(spark, []), EXAMPLE_KEY).count() == 0
