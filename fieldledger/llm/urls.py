"""URL filters: rules by host and path, and gradient-boosted trees for the rest.

The trees are trained here, from labelled URLs, on lexical features and on how often
the labelled URLs of a host suffix are bad. Everything is DataFrame functions and the
DataFrame-based trees of Spark ML.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import sized
from fieldledger.llm.registry import query, table
from fieldledger.scratch import staged

#: (verdict, host, path): the rules of the registered query.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

#: Most labelled URLs that trees are fitted on; of more, those with the least hashes.
TRAINING_ROWS = 20_000
TREES, DEPTH, SEED = 12, 4, 17

#: Weight of the overall share of bad URLs in a suffix's own share.
SMOOTHING = 20.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LEXICAL = [
    "length", "host_length", "path_length", "depth", "labels", "digits", "host_digits",
    "hyphens", "entropy", "parameters", "has_fragment", "longest_segment",
]
SUFFIXES = ["suffix1", "suffix2"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z folded, and path; both empty for null and without `://`."""
    parts = [F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", i) for i in (1, 2)]
    return F.translate(parts[0], _UPPER, _LOWER), parts[1]


def fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    """Whether the rule's host is `host` or above it, and `path` starts with the rule's."""
    _, at, start = rule
    return ((host == at) | host.endswith(f".{at}")) & path.startswith(start)


def first_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, nulls if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(ordered):
        does = fits(host, path, rule)
        name = F.when(does, F.lit(rule[1] + rule[2])).otherwise(name)
        verdict = F.when(does, F.lit(rule[0])).otherwise(verdict)
    return name, verdict


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    size = F.length(text)
    return F.aggregate(
        F.array_distinct(F.split(text, "")),
        F.lit(0.0),
        lambda total, c: total
        - F.when(c == "", 0.0).otherwise(
            (1 - F.length(F.replace(text, c, F.lit(""))) / size)
            * F.log2(F.greatest(1 - F.length(F.replace(text, c, F.lit(""))) / size, F.lit(1e-12)))
        ),
    )


def features(urls: DataFrame, url: str = "url") -> DataFrame:
    """`urls` with host, path, the LEXICAL features and the two last labels of the host."""
    text = F.coalesce(F.col(url), F.lit(""))
    host, path = host_and_path(F.col(url))
    parts = urls.withColumns({"host": host, "path": path, "text_": text})
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    question = F.regexp_extract("text_", r"(?s)\?([^#]*)", 1)
    names = F.split("host", r"\.")
    return parts.withColumns(
        {
            "length": F.length("text_"),
            "host_length": F.length("host"),
            "path_length": F.length("path"),
            "depth": F.size(segments),
            "labels": F.size(names),
            "digits": _share(F.length(F.regexp_replace("text_", "[^0-9]", "")), F.length("text_")),
            "host_digits": _share(F.length(F.regexp_replace("host", "[^0-9]", "")), F.length("host")),
            "hyphens": F.length(F.regexp_replace("host", "[^-]", "")),
            "entropy": _entropy(F.col("text_")),
            "parameters": F.when(question == "", 0).otherwise(F.size(F.split(question, "&"))),
            "has_fragment": F.contains("text_", F.lit("#")).cast("int"),
            "longest_segment": F.coalesce(F.array_max(F.transform(segments, F.length)), F.lit(0)),
            "suffix1": F.substring_index("host", ".", -1),
            "suffix2": F.substring_index("host", ".", -2),
        }
    ).drop("text_")


@dataclass
class UrlModel:
    """Trees over lexical features and suffix shares; `usual` where there is one class only."""

    trees: PipelineModel | None
    shares: dict[str, DataFrame]
    overall: float

    def _with_shares(self, urls: DataFrame) -> DataFrame:
        for name, shares in self.shares.items():
            urls = urls.join(sized(shares), name, "left").fillna(self.overall, [f"{name}_bad"])
        return urls

    def bad(self, featured: DataFrame, name: str) -> DataFrame:
        """`featured` with a column for whether the URL is bad."""
        if self.trees is None:
            return featured.withColumn(name, F.lit(self.overall >= 0.5))
        columns = [F.col(c) for c in featured.columns]
        out = self.trees.transform(self._with_shares(featured))
        return out.select(*columns, (vector_to_array("probability")[1] >= 0.5).alias(name))


def train(labelled: DataFrame, rows: int = TRAINING_ROWS) -> UrlModel:
    """A model from URLs with `features` and a column `bad` of 0 and 1.

    Suffix shares come from all labelled URLs. Trees are fitted on about `rows` of them,
    chosen by hash. With one class only, or no labels, there are no trees, and the
    verdict is that class, or good.
    """
    labelled = staged(labelled, "labelled-urls")
    count, bad = labelled.agg(F.count("*"), F.sum("bad")).first()
    overall = float(bad or 0) / max(count, 1)
    shares = {}
    for name in SUFFIXES:
        share = (F.sum("bad") + SMOOTHING * overall) / (F.count("*") + SMOOTHING)
        shares[name] = staged(labelled.groupBy(name).agg(share.alias(f"{name}_bad")), name)
    model = UrlModel(None, shares, overall)
    if bad in (None, 0, count):
        return model
    bucket = F.pmod(F.xxhash64(*LEXICAL, "host", "path"), F.lit(1 << 20))
    chosen = labelled.where(bucket < int((1 << 20) * min(1.0, rows / count)))
    known = staged(model._with_shares(chosen), "training-urls").repartition(4, "host", "path")
    vector = VectorAssembler(inputCols=LEXICAL + [f"{n}_bad" for n in SUFFIXES], outputCol="vector")
    trees = GBTClassifier(
        featuresCol="vector", labelCol="bad", maxIter=TREES, maxDepth=DEPTH, seed=SEED
    )
    if known.select("bad").distinct().count() == 2:
        model.trees = PipelineModel([vector, trees.fit(vector.transform(known))])
    return model


def url_verdicts(
    pages: DataFrame, page: str = "page_id", url: str = "url", rules: list | None = None
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    A rule decides where one fits, the trees elsewhere; they learn from the URLs that
    rules decide. A null URL has an empty host and path. Repeated pages are judged each
    for itself; other columns are not read.
    """
    rules = RULES if rules is None else rules
    slim = features(pages.select(F.col(page).alias("page_id"), F.col(url).alias("url")))
    name, verdict = first_rule(F.col("host"), F.col("path"), rules)
    judged = staged(slim.withColumns({"rule": name, "ruled": verdict}), "urls")
    ruled = judged.where("ruled is not null")
    model = train(ruled.withColumn("bad", (F.col("ruled") == "block").cast("int")))
    method = F.when(F.col("bad"), "block").otherwise("allow")
    return model.bad(judged, "bad").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict")
    )


@query("op7_url_filter")
def op7_url_filter(spark, folder):
    return url_verdicts(table(spark, folder, "pages"))
