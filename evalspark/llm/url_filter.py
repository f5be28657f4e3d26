"""Judge URLs: the longest matching rule, else gradient-boosted trees on lexical features.

Rules are (host suffix, path prefix, verdict). URLs that a rule decides are the labelled
rows; the trees learn from a bounded sample of them and judge the rest. Features are
text statistics of the URL only, computed as Spark expressions, and the trees are
Spark's own, so nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

#: (rule as written, host suffix, path prefix, verdict).
RULES = (
    ("net/", "net", "/", "block"),
    ("example.net/en/", "example.net", "/en/", "allow"),
    ("example.com/de/", "example.com", "/de/", "block"),
    ("org/fr/", "org", "/fr/", "allow"),
)
#: At most so many labelled rows are learned from, the first in order of a hash.
TRAIN_ROWS = 20_000
ROUNDS, DEPTH, BINS, SEED = 12, 4, 32, 7


def with_host_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add host (A-Z lower-cased) and path; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return pages.withColumns({"host": F.translate(host, upper, lower), "path": path})


def rule_columns(rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    name = verdict = None
    for rule, suffix, prefix, says in ordered:
        own = (F.col("host") == suffix) | F.col("host").endswith("." + suffix)
        fits = own & F.col("path").startswith(prefix)
        name = F.when(fits, rule) if name is None else name.when(fits, rule)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    return name, verdict


def _share(text: Column, pattern: str, size: Column) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")) / F.greatest(size, F.lit(1))


def features(url: Column) -> dict[str, Column]:
    """Lexical statistics: lengths, depth, shares, entropy, parameters, suffix."""
    path, host = F.col("path"), F.col("host")
    size = F.length(url)
    # Sorted, equal characters are runs: one pass sums up n * log2(n) over the whole host.
    weigh = lambda n: n * F.log2(F.greatest(n, F.lit(1.0)))
    start = F.struct(F.lit("").alias("c"), F.lit(0.0).alias("n"), F.lit(0.0).alias("s"))
    runs = F.aggregate(
        F.array_sort(F.filter(F.split(host, ""), lambda c: c != "")),
        start,
        lambda m, c: F.struct(
            c.alias("c"),
            F.when(m["c"] == c, m["n"] + 1.0).otherwise(F.lit(1.0)).alias("n"),
            F.when(m["c"] == c, m["s"]).otherwise(m["s"] + weigh(m["n"])).alias("s"),
        ),
        lambda m: m["s"] + weigh(m["n"]),
    )
    total = F.greatest(F.length(host), F.lit(1))
    entropy = F.log2(total) - runs / total
    suffix = F.substring_index(host, ".", -1)
    found = {
        "length": size,
        "host_length": F.length(host),
        "path_length": F.length(path),
        "labels": F.size(F.split(host, r"\.")),
        "depth": F.size(F.split(path, "/")),
        "digit_share": _share(url, r"[^0-9]", size),
        "vowel_share": _share(host, r"[^aeiou]", F.length(host)),
        "mark_share": _share(url, r"[A-Za-z0-9]", size),
        "entropy": entropy,
        "parameters": F.size(F.split(url, "[?&]")) - 1,
        "fragment": F.contains(url, F.lit("#")),
        "dash": F.length(F.regexp_replace(url, "[^-]", "")),
        "page_suffix": F.regexp_like(path, F.lit(r"\.[A-Za-z0-9]{1,5}$")),
        "suffix_length": F.length(suffix),
        "suffix_code": F.pmod(F.xxhash64(suffix), F.lit(64)),
        "domain_code": F.pmod(F.xxhash64(F.substring_index(host, ".", -2)), F.lit(64)),
        "first_code": F.pmod(F.xxhash64(F.get(F.split(path, "/"), F.lit(1))), F.lit(64)),
    }
    return {f"_{k}": F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in found.items()}


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score (of the trees; null where a rule decides).

    A null URL, or one without ``://``, has an empty host and path and is judged by the trees
    from those. Without labelled rows of both verdicts nothing can be learned: every URL gets
    the one verdict seen, or allow. Repeated rows are judged alike; an empty table gives no
    rows; other columns are not read.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    rule, verdict = rule_columns(rules)
    base = with_host_path(pages.select("page_id", "url")).withColumns({"rule": rule, "_says": verdict})
    made = features(url)
    rows = base.withColumns(made).select("page_id", "host", "path", "rule", "_says", *made)
    data = VectorAssembler(inputCols=list(made), outputCol="_features").transform(rows)
    data = data.select("page_id", "host", "path", "rule", "_says", "_features")
    labelled = base.filter("_says IS NOT NULL").groupBy("_says").count().collect()
    seen = sorted(r["_says"] for r in labelled)
    out = ["page_id", "host", "path", "rule"]
    if len(seen) < 2:
        plain = F.coalesce("_says", F.lit(seen[0] if seen else "allow")).alias("verdict")
        return base.select(*out, plain, F.lit(None).cast("double").alias("score"))
    sample = (
        data.filter("_says IS NOT NULL")
        .orderBy(F.xxhash64("page_id", "host", "path"), "page_id")
        .limit(TRAIN_ROWS)
        .select("_features", (F.col("_says") == "block").cast("double").alias("label"))
    )
    trees = GBTClassifier(
        featuresCol="_features",
        maxIter=ROUNDS,
        maxDepth=DEPTH,
        maxBins=BINS,
        stepSize=0.3,
        seed=SEED,
    ).fit(sample)
    judged = trees.transform(data).withColumn("_block", vector_to_array("probability")[1])
    return judged.select(
        *out,
        F.coalesce("_says", F.when(F.col("_block") >= 0.5, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("_says").isNull(), F.col("_block")).alias("score"),
    )
