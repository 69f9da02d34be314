"""Literal rows for the traps that the test tables do not reach."""

import json

import pytest
from pyspark.sql import functions as F

from fieldledger.functions import casts, chat, records, report, text
from fieldledger.operators import clean, enrich, profile, quality
from fieldledger.operators import records as record_ops

c = F.col


def column(spark, values, expression, kind="string"):
    """The expression over one column `v` with the values, in their order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r.x for r in rows.select("i", expression.alias("x")).orderBy("i").collect()]


def test_lenient_year(spark):
    given = ["1970.5", " 1970 ", ".5", "1e3", "abc", "99999999999", None, "+7", "-3.9", "5d", ""]
    expected = [1970, 1970, 0, None, None, None, None, 7, -3, None, None]
    assert column(spark, given, casts.lenient_year(c("v"))) == expected


def test_whole_count_of_double_or_zero(spark):
    given = [None, "n/a", "NaN", "0.5", "-3.7", "Infinity", "12", "1e30"]
    assert column(spark, given, casts.whole_count(casts.double_or_zero(c("v")))) == [0, 0, 0, 0, -3, 0, 12, 0]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_casts_do_not_depend_on_ansi(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert column(spark, ["x", "1970.5"], casts.lenient_year(c("v"))) == [None, 1970]
        assert column(spark, ["x", "2.5"], casts.double_or_zero(c("v"))) == [0.0, 2.5]
        assert column(spark, ["20xx0101", "19990101", ""], casts.year_prefix(c("v"))) == [None, 1999, None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_code_length_is_checked_before_trimming(spark):
    log = spark.createDataFrame(
        [("20150101", code) for code in ["afg", "AFG", "AFG ", " AF", "ZZZ", None]], "_c1 string, _c7 string"
    )
    lookup = spark.createDataFrame([("AFG", "Afghanistan"), ("AF", "Wrong")], "code string, name string")
    rows = clean.activity_rows(log)
    named = enrich.code_lookup_join(rows.filter(F.col("g_code") != " AF"), lookup)
    assert sorted((r.g_code, r.g_country) for r in named.collect()) == [("AFG", "Afghanistan"), ("afg", "Afghanistan")]
    (total,) = enrich.activity_by_year_country(rows, lookup.filter("code = 'AFG'")).collect()
    assert (total.g_year, total.g_country, total.evt_count) == (2015, "Afghanistan", 2)


def test_title_case_is_pythons(spark):
    given = ["BOMBING/EXPLOSION", "HOSTAGE TAKING (KIDNAPPING)", "O'NEIL 3RD", "", "éCOLE à-b", "a  b"]
    assert column(spark, given, text.title_case(c("v"))) == [s.title() for s in given]


def test_label_of(spark):
    given = [
        "X — B — Z | C", "X — BOMBING/EXPLOSION | Iraq | 2017\nmore — no | x", "no mark | x", "", "X —  | C",
        "X —  PAD \t| C", "X — only", "first\nX — B | C", "X —B | C",
    ]

    def python(output):
        line = output.split("\n")[0].split("— ", 1)
        return line[1].split(" |")[0].strip().title() if len(line) > 1 else None

    assert column(spark, given, text.label_of(c("v"))) == [python(g) for g in given]


def test_word_count_is_pythons(spark):
    given = ["", "  ", " a  b ", "a b", "a\x1cb\x1fc", "x y　z", "one", "a​b", "\x85a", "tab\tline\nfeed"]
    assert column(spark, given, text.word_count(c("v"))) == [len(s.split()) for s in given]


def test_strip_and_nonblank_are_pythons(spark):
    given = ["", " ", " x ", "\x1fa b\x1c", "\n\ta\n", "　"]
    assert column(spark, given, casts.strip(c("v"))) == [s.strip() for s in given]
    assert column(spark, given, text.nonblank(c("v"))) == [bool(s.strip()) for s in given]


def test_whole_percent_rounds_half_to_even(spark):
    given = [(1, 8), (3, 8), (1, 3), (2, 3), (0, 5), (5, 5), (1, 200), (3, 200)]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(given)], "i int, a bigint, b bigint")
    got = rows.orderBy("i").select(text.whole_percent(c("a"), c("b"))).collect()
    assert [r[0] for r in got] == [f"{100 * a / b:.0f}%" for a, b in given]


def decode(spark, lines):
    frame = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, value string")
    parsed, record = records.decoded(frame)
    return parsed, record


def test_decoded_record(spark):
    lines = [
        "{}", "[1]", "junk", '{"instruction": 5, "output": "x"}', '{"instruction": null}',
        '{"instruction": "a b", "output": "X — L | y"}', '{"output": "o"} trailing', '{"output": "o"}, {"a": 1}',
        ' {"output": "o"} ', "", None, '"text"', '{"output": {"k": "v"}}', '[{"output": "o"}]', "{}, null",
        '{"output": "x"}]', '{"a": 1}],[{"b": 2}', "null", "5", "[]", "]", "],[", '{"a": 1, "a": 2}',
        '{"instruction": "a", "instruction": "b"}', '{"instruction": NaN}', '{"a": NaN, "output": "x"}',
        "{'output': 'a'}", '{"output": "a\tb"}', '{"output": "x"', '{"x": {"instruction": 3}, "output": "\\u00e9"}',
        '{"output": 012}', '{"a": tru}', '{output: "x"}', '{"output": "x",}', "// c\n{}",
    ]
    parsed, record = decode(spark, lines)
    got = parsed.select("i", record.text("instruction"), record.text("output")).orderBy("i").collect()

    def python(line, key):
        try:
            value = json.loads(line).get(key, "")
        except Exception:
            return None
        return value if isinstance(value, str) else None

    assert [tuple(r)[1:] for r in got] == [(python(s, "instruction"), python(s, "output")) for s in lines]


def test_corrupt_kinds(spark):
    lines = ["junk", "", " ", None, "{} {}", "{}]", "[1]", "5", '"t"', "null", "true", "{}", '{"output": 5}', '{"output": "X — a"}']
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    got = {r.kind: r.n_rows for r in quality.corrupt_record_report(frame).collect()}
    assert got == {"not_json": 6, "not_object": 5, "no_label": 1, "not_text": 1, "ok": 1}


def test_profile_rows_of_broken_lines(spark):
    lines = ["{}", "[1]", "junk", '{"instruction": 5, "output": "x"}', '{"instruction": null}']
    frame = spark.createDataFrame([(s, "train") for s in lines], "value string, split string")
    got = [(r.token_len, r.label, r.parsed) for r in record_ops.profile_rows(frame).collect()]
    assert got == [(0, None, False)] + [(None, None, False)] * 4


@pytest.mark.parametrize("encode", [records.encode_record, records.encode_record_spaced])
def test_encoded_record_parses_to_its_fields(spark, encode):
    values = ['"', "\\", "\t", "\x1f", "é", "", "a\nb", "日本 😀", '\\"', " ", "/"]
    got = column(spark, values, encode(F.lit("sys"), c("v"), F.concat(c("v"), F.lit("!"))))
    expected = [{"system": "sys", "instruction": v, "input": "", "output": v + "!"} for v in values]
    assert [json.loads(s) for s in got] == expected
    assert all(list(json.loads(s)) == ["system", "instruction", "input", "output"] for s in got)


def test_spaced_record_has_pythons_bytes(spark):
    values = ['"', "\\", "\t", "é", "", "a\nb", "日本 😀", "/", "\x7f"]
    got = column(spark, values, records.encode_record_spaced(F.lit("sys"), c("v"), c("v")))
    expected = [
        json.dumps({"system": "sys", "instruction": v, "input": "", "output": v}, ensure_ascii=False) for v in values
    ]
    assert got == expected


def test_record_is_null_without_its_texts(spark):
    assert column(spark, [None, "a"], records.encode_record(F.lit("s"), c("v"), F.lit("o")))[0] is None


def test_casualty_clause(spark):
    t = report.ReportTemplate()
    rows = spark.createDataFrame(
        [(0, 0, 0), (1, 1, 0), (2, 2, 1), (3, -3, 2), (4, 0, 1), (5, -1, -1)], "i int, k bigint, w bigint"
    )
    got = rows.orderBy("i").select(report.casualty_clause(t, c("k"), c("w"))).collect()
    assert [r[0] for r in got] == [
        "with no casualties", "with 1 death and 0 wounded", "with 2 deaths and 1 wounded",
        "with -3 deaths and 2 wounded", "with 0 deaths and 1 wounded", "with no casualties",
    ]


def test_attribution_keeps_the_untrimmed_name(spark):
    got = column(spark, [" Unknown ", " Alpha ", "", "  ", None, "unknown"], report.attribution_clause(report.ReportTemplate(), c("v")))
    assert got == ["", "It was attributed to  Alpha .", "", "", "", "It was attributed to unknown."]


def test_severity_and_context(spark):
    assert column(spark, [-1, 2, 3, 9, 10], report.severity_bucket(c("v")), "bigint") == ["low", "low", "moderate", "moderate", "high"]
    got = column(spark, [0, 107464], report.context_clause(report.ReportTemplate(), c("v"), F.lit("Yemen"), F.lit(2017)), "bigint")
    assert "107,464" in got[1] and "no events" in got[0]


INCIDENT = (
    "year int, country string, attack_type string, target_type string, weapon_type string, "
    "kills double, wounds double, group_name string, evt_count bigint"
)


def test_whole_report(spark):
    given = [
        (2017, "Yemen", "Unarmed Assault", "Citizens", "Vehicle", 1.0, 1.0, "Group A", 107464),
        (1970, "Peru", "Bombing", None, None, 0.0, 0.0, None, 0),
    ]
    full, bare = (
        r.output for r in record_ops.render_reports(spark.createDataFrame(given, INCIDENT)).orderBy(F.desc("year")).collect()
    )
    assert full.split("\n") == [
        "INCIDENT REPORT — UNARMED ASSAULT | Yemen | 2017",
        "",
        "A Unarmed Assault incident was recorded in Yemen in 2017, with 1 death and 1 wounded.",
        "Its target was Citizens.",
        "The weapon was Vehicle.",
        "It was attributed to Group A.",
        "",
        "CONTEXT: The activity log holds 107,464 events for Yemen in 2017.",
        "",
        "ASSESSMENT: The severity is low; keep watching Yemen.",
    ]
    lines = bare.split("\n")
    assert len(lines) == 10 and lines[3:7] == ["", "", "", ""] and "no casualties" in lines[2]


def test_own_wording(spark):
    own = report.ReportTemplate(header="CARD {country}: {label}", target="T={target}", no_context="none")
    frame = spark.createDataFrame([(2017, "Yemen", "X", "Y", None, 0.0, 0.0, None, 0)], INCIDENT)
    lines = record_ops.render_reports(frame, own).first().output.split("\n")
    assert lines[0] == "CARD Yemen: X" and lines[3] == "T=Y" and lines[7] == "CONTEXT: none"


def test_histogram_edges(spark):
    lengths = spark.createDataFrame([(n,) for n in [0, 24, 25, 799, 800, 801, 5000]], "token_len int")
    got = {r.bin: r.n_rows for r in profile.token_length_histogram(lengths).collect()}
    assert len(got) == 33 and {b: n for b, n in got.items() if n} == {0: 2, 1: 1, 31: 2, 32: 2}
    stats = profile.token_length_stats(lengths).first()
    assert (stats.n_capped, stats.min_capped, stats.max_capped, stats.mean_capped) == (5, 0, 800, 329)
    assert (stats.n_all, stats.max_all) == (7, 5000)


def test_tables_agree_with_and_without_weights(spark):
    rows = spark.createDataFrame([(i % 7 * 30,) for i in range(500)], "token_len int")
    counted = rows.groupBy("token_len").agg(F.count("*").alias("n_rows"))
    for table in (profile.token_length_histogram, profile.token_length_stats):
        assert sorted(table(rows).collect()) == sorted(table(counted, weight="n_rows").collect())


def test_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "split string, label string, token_len int, parsed boolean, n_rows bigint")
    row = profile.dataset_summary(empty).first()
    assert (row.n_labels, row.top_label) == (0, None)


def test_message_list_leaves_out_what_is_missing(spark):
    got = column(spark, ["s", None], chat.message_list(c("v"), F.lit("u")))
    assert [[tuple(m) for m in ms] for ms in got] == [[("system", "s"), ("user", "u")], [("user", "u")]]


def test_context_is_added_only_if_not_blank(spark):
    got = column(spark, ["", "  ", "more"], chat.with_context(F.lit("ask"), c("v")))
    assert got == ["ask", "ask", "ask\n\nContext: more"]
