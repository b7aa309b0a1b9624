"""URL filter: rules by host and path, and gradient-boosted trees on lexical features for the rest.

Features are built-in expressions over the URL text, plus how often its suffix (the last two labels
of the host) occurs among all pages and how often labelled URLs with that suffix are blocked, counted
over all of them. The trees are Spark's own and learn from labelled rows, at most about ``LABELLED``
of them, each drawn by itself, so that repeated URLs are drawn no more often than others.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and is
judged by the trees; repeated rows are separate pages; where the labels are all alike, or none, that
label (or allow) is the verdict; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapline.operators.joins import spread_join
from snapline.session import scratch

ALLOW, BLOCK = "allow", "block"
LABELLED = 20_000
TREES, DEPTH, SEED = 20, 4, 7
FEATURES = (
    "length", "host_length", "path_length", "depth", "labels", "digits", "host_digits", "hyphens", "entropy",
    "parameters", "suffix_pages", "suffix_blocked",
)

Rule = tuple[str, str]  # verdict, host and path prefix


def host_and_path(url: str) -> tuple[Column, Column]:
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)://(.*)$", 1)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    # A-Z only: lower() would also change letters beyond ASCII.
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return low, F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)


def fitting_rule(rules: Sequence[Rule], host: str, path: str) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, as one expression over a stated list of rules."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, prefix = text.partition("/")
        at_host = (F.col(host) == domain) | F.col(host).endswith(f".{domain}")
        fits = at_host & F.col(path).startswith(slash + prefix)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def lexical(df: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """``df`` with the features of its URLs but for the suffix statistics."""
    text = F.coalesce(F.col(url), F.lit(""))
    n = F.length(text)
    count = lambda column, sign: F.length(column) - F.length(F.replace(column, F.lit(sign), F.lit("")))
    digits = lambda column: F.length(F.regexp_replace(column, "[^0-9]", "")) / F.greatest(F.length(column), F.lit(1))
    labels = F.split(host, r"\.")
    df = df.withColumns({"__signs": F.split(text, ""), "suffix": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")})
    share = lambda sign: F.size(F.filter("__signs", lambda s: s == sign)) / F.greatest(n, F.lit(1))
    entropy = F.aggregate(F.array_distinct("__signs"), F.lit(0.0), lambda a, sign: a - share(sign) * F.log2(share(sign)))
    return df.withColumns({
        "length": n.cast("double"), "host_length": F.length(host).cast("double"), "path_length": F.length(path).cast("double"),
        "depth": count(F.col(path), "/").cast("double"), "labels": F.size(labels).cast("double"), "digits": digits(text),
        "host_digits": digits(F.col(host)), "hyphens": count(F.col(host), "-").cast("double"), "entropy": F.coalesce(entropy, F.lit(0.0)),
        "parameters": (count(text, "=") + count(text, "&")).cast("double"),
    }).drop("__signs")


def judge(pages: DataFrame, labelled: DataFrame, columns: Sequence[str], limit: int = LABELLED) -> DataFrame:
    """``columns`` of ``pages`` and ``guess``, the trees' verdict.

    Both frames have the columns of :func:`lexical`; ``labelled`` also ``blocked``, 0.0 or 1.0.
    """
    spark = pages.sparkSession
    n = labelled.count()
    drawn = labelled.where(F.rand(SEED) < min(1.0, limit / max(n, 1)))
    known = labelled.groupBy("suffix").agg(F.sum("blocked").alias("b"), F.count("*").alias("k"))
    seen = pages.groupBy("suffix").agg(F.log1p(F.count("*")).alias("suffix_pages"))
    stats = seen.join(known, "suffix", "full").select(
        F.col("suffix").alias("s"), F.coalesce("suffix_pages", F.lit(0.0)).alias("suffix_pages"),
        F.coalesce("b", F.lit(0.0)).alias("b"), F.coalesce("k", F.lit(0)).alias("k"),
    )
    path = scratch(spark, "suffixes")
    stats.write.parquet(path)
    stats = spark.read.parquet(path)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="__features")
    path = scratch(spark, "labelled")
    # A labelled row's own label is left out of its suffix's share.
    others = (F.col("b") - F.col("blocked") + 1) / (F.col("k") + 1)
    examples = spread_join(drawn, stats, [("suffix", "s")], "inner").withColumn("suffix_blocked", others)
    examples.select("blocked", *FEATURES).coalesce(8).write.parquet(path)
    sample = spark.read.parquet(path)
    kinds = [r["blocked"] for r in sample.select("blocked").distinct().collect()]
    if len(kinds) < 2:
        return pages.select(*columns, F.lit(BLOCK if kinds == [1.0] else ALLOW).alias("guess"))
    trees = GBTClassifier(
        labelCol="blocked", featuresCol="__features", predictionCol="__blocked",
        maxIter=TREES, maxDepth=DEPTH, seed=SEED,
    ).fit(assembler.transform(sample))
    share = (F.col("b") + 1) / (F.col("k") + 2)
    whole = assembler.transform(spread_join(pages, stats, [("suffix", "s")], "inner").withColumn("suffix_blocked", share))
    return trees.transform(whole).select(*columns, F.when(F.col("__blocked") == 1.0, BLOCK).otherwise(ALLOW).alias("guess"))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict``; without ``labelled`` (``url, blocked``) the trees learn
    from the URLs that the rules decide."""

    def prepared(df: DataFrame, *kept: Column) -> DataFrame:
        host, path = host_and_path("url")
        df = df.select("url", *kept).withColumns({"host": host, "path": path})
        rule, verdict = fitting_rule(rules, "host", "path")
        return lexical(df.withColumns({"rule": rule, "verdict": verdict}), "url", "host", "path")

    own = prepared(pages.withColumnRenamed(url_col, "url"), F.col(id_col).alias("page_id"))
    if labelled is None:
        decided = own.where(F.col("verdict").isNotNull()).withColumn("blocked", (F.col("verdict") == BLOCK).cast("double"))
    else:
        decided = prepared(labelled, F.col("blocked").cast("double"))
    judged = judge(own, decided, ["page_id", "host", "path", "rule", "verdict"])
    return judged.select("page_id", "host", "path", "rule", F.coalesce("verdict", "guess").alias("verdict"))
