"""URL filter by host-suffix and path-prefix expressions.

Every URL is expanded into its host suffixes times its path prefixes; both sides are joined on
the first bytes of the expression's SHA-256, the full digest confirms the match, and the
longest rule wins.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_DIGITS = 8
DEFAULT_VERDICT = "allow"

RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_of(url: str) -> Column:
    """From the first ``://`` up to a slash, question mark, hash or the end; else empty."""
    found = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return lower_ascii(F.coalesce(found, F.lit("")))


def path_of(url: str) -> Column:
    """What follows the host, up to a question mark, hash or the end; else empty."""
    found = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _expression(host: Column, path: Column) -> Column:
    """A host has no slash and a path begins with one, so the text is unambiguous."""
    return F.concat(host, F.lit("\n"), path)


def _labels(host: str) -> Column:
    return F.split(host, r"\.")


def host_suffixes(host: str, sizes: list[int]) -> Column:
    """The host's ends of so many labels; as long as some rule's host, whatever the host's."""
    labels = _labels(host)
    wanted = F.filter(
        F.array(*[F.lit(n) for n in sizes]).cast("array<int>"), lambda n: n <= F.size(labels)
    )
    return F.transform(
        wanted, lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = DEFAULT_VERDICT,
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict.

    ``rules`` has host, path and verdict; a rule fits its host and all subdomains if the URL's
    path starts with the rule's.  The rule with the longest host wins, then the longest path,
    then "block".  ``rule`` is the rule's host and path without a leading slash alone, such as
    ``net/es/``; where none fits it is null and the verdict is ``default``.  A null URL, or
    one without ``://``, has an empty host and path.  Repeated rules count once, rules with a
    null part never fit, repeated rows stay rows of their own; other columns are ignored.  A very
    long URL gives no more expressions than a short one: as many as rules have shapes.
    """
    rules = (
        rules.select(
            lower_ascii(F.col("host")).alias("r_host"),
            F.col("path").alias("r_path"),
            F.col("verdict").alias("r_verdict"),
        )
        .dropna()
        .distinct()
        .withColumn("r_digest", F.sha2(_expression(F.col("r_host"), F.col("r_path")), 256))
        .withColumn("r_prefix", F.substring("r_digest", 1, PREFIX_DIGITS))
    )
    # Ends and prefixes need only be as long as some rule's host and path.
    shapes = rules.select(
        F.size(_labels("r_host")).alias("labels"), F.char_length("r_path").alias("length")
    )
    shapes = shapes.distinct().collect()
    lengths, sizes = {r.length for r in shapes}, {r.labels for r in shapes}
    rows = pages.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).alias("page_id"),
        host_of(url_col).alias("host"),
        path_of(url_col).alias("path"),
    )
    prefixes = F.filter(
        F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>"),
        lambda n: n <= F.char_length("path"),
    )
    exploded = (
        rows.withColumn("suffix", F.explode_outer(host_suffixes("host", sorted(sizes))))
        .withColumn("length", F.explode_outer(prefixes))
        .withColumn(
            "digest",
            F.sha2(_expression(F.col("suffix"), F.expr("left(path, length)")), 256),
        )
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
        .drop("suffix", "length")
    )
    matched = exploded.join(rules, F.col("prefix") == F.col("r_prefix"), "left")
    rank = F.when(
        F.col("digest") == F.col("r_digest"),
        F.struct(
            F.char_length("r_host").alias("h"),
            F.char_length("r_path").alias("p"),
            (F.col("r_verdict") == "block").alias("b"),
            F.col("r_verdict").alias("verdict"),
            F.concat("r_host", "r_path").alias("rule"),
        ),
    )
    best = matched.groupBy("row_id", "page_id", "host", "path").agg(F.max(rank).alias("best"))
    return best.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
