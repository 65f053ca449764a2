"""URL filter: allow and block rules, and gradient-boosted trees for what no rule fits.

The rules label URLs; trees learn from the labelled ones what a blocked URL looks like and judge
the others. Features are lexical: lengths, depth, digit ratio, entropy of the characters,
parameters of the query part, and how often URLs of the same registered suffix, and of the same parent host below it,
are blocked, each shrunk towards the share of the next larger whole. These statistics are counted over
all labelled URLs, less the URL's own label. The registered suffix is the last part of the host, or the last two
where a country's two letters follow a part of at most three (``co.uk``); the parent host has one part more.

The trees are fitted on a sample of distinct labelled URLs, chosen by hash: about ``SAMPLE / 2`` of either
kind, all of a kind that has fewer. Every URL is judged. Without labels of both kinds, the one
kind there is decides; without any, allow.

A null URL, or one without ``://``, has an empty host and path, fits no rule and is judged by the
trees. Equal rows get equal verdicts. An empty table gives an empty result. Very long URLs are taken whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import stored

# The rules of the contract (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
SAMPLE, TREES, DEPTH, SEED = 20_000, 10, 4, 42
#: Labelled URLs that the overall block share stands for in a suffix's share.
PRIOR = 20.0
FEATURES = [
    "n_chars", "host_chars", "path_chars", "host_parts", "depth", "digit_ratio", "hyphens", "entropy", "parameters", "parameter_chars", "fragment",
    "suffix_rate", "parent_rate",
]

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, path) with host and path as the contract cuts them."""
    url = F.coalesce("url", F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return pages.select(
        "page_id",
        url.alias("url"),
        F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _UPPER.lower()).alias("host"),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def _fits(host: str, path: str) -> Column:
    on_host = (F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))
    return on_host & F.startswith(F.col("path"), F.lit(path))


def _longest(rules: list[tuple[str, str, str]], value) -> Column:
    """Of the longest rule that fits, the given value; else null."""
    ordered = sorted(rules, key=lambda r: len(r[1] + r[2]))
    return reduce(lambda rest, r: F.when(_fits(r[1], r[2]), F.lit(value(r))).otherwise(rest), ordered, F.lit(None).cast("string"))


def _count(text: str, characters: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{characters}]", "")).cast("double")


def lexical(urls: DataFrame) -> DataFrame:
    size = F.greatest(F.length("url"), F.lit(1)).cast("double")
    times = F.transform(
        F.array_distinct(F.split("url", "")), lambda c: F.when(c == "", 0).otherwise(F.length("url") - F.length(F.replace("url", c, F.lit(""))))
    )
    query = F.regexp_extract("url", r"^[^?#]*\?([^#]*)", 1)
    parts = F.split("host", r"\.")
    country = (F.length(F.element_at(parts, -1)) == 2) & (F.length(F.get(parts, F.size(parts) - 2)) <= 3)
    wide = F.when((F.size(parts) > 2) & country, 2).otherwise(1)
    entropy = F.aggregate(times, F.lit(0.0), lambda total, n: total - F.when(n > 0, n / size * F.log2(n / size)).otherwise(0.0))
    return urls.withColumns(
        {
            "n_chars": F.length("url").cast("double"),
            "host_chars": F.length("host").cast("double"),
            "path_chars": F.length("path").cast("double"),
            "host_parts": F.size(F.split("host", r"\.")).cast("double"),
            "depth": _count("path", "/"),
            "digit_ratio": _count("url", "0-9") / size,
            "hyphens": _count("url", "-"),
            "entropy": entropy,
            "parameters": F.size(F.array_remove(F.split(query, "&"), "")).cast("double"),
            "parameter_chars": F.length(query).cast("double"),
            "fragment": F.contains("url", F.lit("#")).cast("double"),
            "suffix": F.array_join(F.slice(parts, -wide, wide), "."),
            "parent": F.array_join(F.slice(parts, -F.least(wide + 1, F.size(parts)), wide + 1), "."),
        }
    )


def _with_rates(urls: DataFrame) -> DataFrame:
    """Adds the shares of blocked URLs among the other labelled ones of the suffix and of the parent host, shrunk."""
    overall = urls.agg(F.avg("label")).first()[0] or 0.0  # one row
    own, mine = F.col("label").isNotNull().cast("int"), F.coalesce("label", F.lit(0))
    towards = F.lit(overall)
    for name in ("suffix", "parent"):
        totals = urls.groupBy(F.col(name).alias("of")).agg(F.count("label").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("blocked"))
        # Written, so that a suffix of very many URLs is split by the join that follows.
        totals = stored(totals, "url-rates")
        rate = (F.col("blocked") - mine + towards * PRIOR) / (F.col("n") - own + PRIOR)
        urls = urls.join(totals, F.col(name) == F.col("of")).withColumn(f"{name}_rate", rate).drop("of", "n", "blocked")
        towards = F.col(f"{name}_rate")
    return urls


def training_sample(urls: DataFrame, sample: int) -> DataFrame:
    """About ``sample / 2`` distinct labelled URLs of either kind, those of least hash; all of a kind that has fewer."""
    labelled = urls.filter(F.col("label").isNotNull()).withColumn("place", F.pmod(F.xxhash64("url"), F.lit(1 << 30)))
    counts = labelled.groupBy("label").agg(F.count_distinct(F.xxhash64("url")).alias("n")).collect()  # two rows
    cut = F.lit(0)
    for r in counts:
        cut = F.when(F.col("label") == r["label"], F.lit(min(1 << 30, sample * (1 << 29) // r["n"]))).otherwise(cut)
    return labelled.filter(F.col("place") < cut).dropDuplicates(["url"])


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, sample: int = SAMPLE) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): score is the trees' probability of block, null where there are none."""
    urls = parsed(pages).withColumns({"rule": _longest(rules, lambda r: r[1] + r[2]), "fixed": _longest(rules, lambda r: r[0])})
    label = F.when(F.col("fixed").isNotNull(), (F.col("fixed") == "block").cast("int"))
    rows = stored(lexical(urls.withColumn("label", label)), "url-features")
    kinds = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect() if r["label"] is not None}  # two rows
    if len(kinds) < 2:
        only = "block" if 1 in kinds else "allow"
        return rows.select("page_id", "host", "path", "rule", F.coalesce("fixed", F.lit(only)).alias("verdict"), F.lit(None).cast("double").alias("score"))
    rated = stored(_with_rates(rows), "url-rated")
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features")
    train = stored(training_sample(rated, sample).select("label", *FEATURES), "url-sample")
    judged = trees.fit(vectors.transform(train)).transform(vectors.transform(rated))
    return judged.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("fixed", F.when(F.col("prediction") > 0.5, "block").otherwise("allow")).alias("verdict"),
        vector_to_array("probability")[1].alias("score"),
    )
