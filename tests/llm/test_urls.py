import random
import re

from fieldledger.llm.urls import RULES, features, first_rule, host_and_path, train, url_verdicts
from pyspark.sql import functions as F

SCHEMA = "page_id long, url string, host string, path string, verdict string, bad string"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "p", "v", "b") for i, u in enumerate(urls)], SCHEMA)


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def plain_rule(host, path):
    fitting = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fitting, key=lambda r: len(r[1] + r[2]), default=None)
    return (best[1] + best[2], best[0]) if best else (None, None)


def urls(seed, n):
    rng = random.Random(seed)
    hosts = ["a.example.org", "example.org", "EXAMPLE.com", "x.org", "org", "com", "y.net", "É.com", "badexample.org", "com.net"]
    paths = ["/fr/1", "/de/2?x=1&y=2", "/es/", "/en/1", "/en/12", "/en/2", "", "/", "#top", "?q=/fr/", "/FR/1", "/fr"]
    heads = ["http://", "https://", "", "x://y://", "://"]
    return [rng.choice(heads) + rng.choice(hosts) + rng.choice(paths) for _ in range(n)]


def test_hosts_paths_and_rules(spark):
    given = [None, "", "://", "a\n://b\n/c\nd", *urls(26, 500)]
    found = url_verdicts(pages(spark, given)).collect()
    assert len(found) == len(given)
    for r in found:
        host, path = plain_parts(given[r.page_id])
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def test_held_out_accuracy(spark):
    rng = random.Random(27)

    def url(bad):
        word = "".join(rng.choice("abcdefghij") for _ in range(8))
        if bad:
            return f"http://{rng.randint(100, 99999)}-{word}.{rng.choice(['top', 'net'])}/{rng.randint(1, 10**9)}/a/b?x={rng.randint(0, 9)}&y=1&z=2"
        return f"http://{word}.{rng.choice(['net', 'edu'])}/{word}"

    rows = [(i, url(i % 2), i % 2) for i in range(1200)]
    all_rows = features(spark.createDataFrame(rows, "id long, url string, bad int"))
    model = train(all_rows.where("id < 800"), rows=500)
    held = model.bad(all_rows.where("id >= 800").withColumnRenamed("bad", "truth"), "bad")
    right = held.where(F.col("bad") == (F.col("truth") == 1)).count()
    assert held.count() == 400 and right >= 380


def test_one_class_no_labels_and_no_rows(spark):
    only = ["http://a.org/x", "http://b.net/y", None]
    assert {r.verdict for r in url_verdicts(pages(spark, only)).collect()} == {"allow"}
    blocked = ["http://com/de/1", "http://b.net/y"]
    assert {r.verdict for r in url_verdicts(pages(spark, blocked)).collect()} == {"block"}
    assert {r.verdict for r in url_verdicts(pages(spark, ["http://b.net/y"])).collect()} == {"allow"}
    assert url_verdicts(pages(spark, [])).count() == 0


def test_expressions_by_themselves(spark):
    one = pages(spark, ["http://a.example.org/es/1"])
    host, path = host_and_path(F.col("url"))
    name, verdict = first_rule(host, path, RULES)
    assert one.select(host, path, name, verdict).first()[:] == ("a.example.org", "/es/1", "example.org/es/", "block")
