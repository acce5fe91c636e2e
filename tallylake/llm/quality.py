"""Quality rules with the frequency of lines across documents.

Lines are normalised and hashed, and the distinct texts of a host that have a line are counted;
copies of one text count once.  A line in more than ``max_share`` of the host's texts, and in
more than ``max_texts`` of them, is boilerplate and removed.  A document that keeps less than
``min_left`` of its words is depleted and rejected, as is one that fails the base rules.
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.llm.common import staged

MIN_WORDS = 20
MAX_REPEATED = 0.30
WINDOW_WORDS = 8
MAX_SHARE = 0.05
MAX_TEXTS = 20
MIN_LEFT = 0.30

BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"


def words(text: Column) -> Column:
    """The words of a text; a text without words has none."""
    # Trimmed by characters: a pattern that ends at the end of the text would be tried at every
    # blank of a long run.
    bare = F.btrim(text, F.lit(BLANK_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANKS))


def _word_lines(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def normalised(line: Column) -> Column:
    """Lower case, digits as 0, blanks as one space."""
    low = F.regexp_replace(F.lower(F.btrim(line, F.lit(BLANK_CHARS))), "[0-9]+", "0")
    return F.regexp_replace(low, BLANKS, " ")


def _with_window_hashes(rows: DataFrame, window: int) -> DataFrame:
    """Adds grams: a hash of every window, made of those of two halves, which may overlap.

    Each width is a column of its own, so that it is computed once for all that refers to it.
    """
    rows, width = rows.withColumn("grams", F.transform("words", lambda w: F.xxhash64(w))), 1
    while width < window:
        shift = min(width, window - width)
        rows = rows.withColumn("n_grams", F.greatest(F.size("grams") - shift, F.lit(0)))
        rows = rows.withColumn(
            "grams",
            F.zip_with(
                F.slice("grams", F.lit(1), F.col("n_grams")),
                F.slice("grams", F.lit(shift + 1), F.col("n_grams")),
                lambda a, b: F.xxhash64(a, b),
            ),
        )
        width += shift
    return rows.drop("n_grams")


def _with_repeats(rows: DataFrame, window: int) -> DataFrame:
    """Adds n_repeat_words: the words inside windows that the text has twice or more."""
    rows = _with_window_hashes(rows, window)
    # Most texts repeat nothing; the others have their windows sorted by hash.
    placed = F.when(
        F.size(F.array_distinct("grams")) < F.size("grams"),
        F.sort_array(
            F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("i")))
        ),
    ).otherwise(F.expr("cast(array() as array<struct<h:bigint,i:int>>)"))
    rows = rows.withColumn("placed", placed)

    def equal(a: Column, b: Column) -> Column:
        # A hash may meet another window's by chance, so the words are compared as well.
        return (a["h"] == b["h"]) & (
            F.slice("words", a["i"] + 1, window) == F.slice("words", b["i"] + 1, window)
        )

    again = F.filter(
        "placed",
        lambda x, n: ((n > 0) & equal(x, F.get("placed", n - 1)))
        | ((n < F.size("placed") - 1) & equal(x, F.get("placed", n + 1))),
    )
    starts = F.sort_array(F.transform(again, lambda x: x["i"]))
    rows = rows.withColumn("starts", starts)
    covered = F.aggregate(
        F.transform(
            "starts",
            lambda at, n: F.when(
                n < F.size("starts") - 1, F.least(F.get("starts", n + 1) - at, F.lit(window))
            ).otherwise(window),
        ),
        F.lit(0).cast("bigint"),
        lambda total, x: total + x,
    )
    return rows.withColumn("n_repeat_words", covered).drop("grams", "placed", "starts")


def base_metrics(rows: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``rows`` (text) with words and the base counts of every text."""
    lines = _word_lines(F.col("text"))
    rows = rows.withColumn("words", words(F.col("text"))).withColumn("lines", lines)
    rows = rows.withColumns(
        {
            "n_words": F.size("words").cast("bigint"),
            "word_chars": F.char_length(F.array_join("words", "")).cast("bigint"),
            "n_symbols": F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        }
    )
    return _with_repeats(rows, window)


METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_rules(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_words: int = MIN_WORDS,
    max_repeated: float = MAX_REPEATED,
    max_share: float = MAX_SHARE,
    max_texts: int = MAX_TEXTS,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """One row per row of ``documents``: doc_id, host, text_key, METRICS, the verdict.

    ``n_boilerplate_words`` counts the words of removed lines and ``removed`` holds those
    lines' hashes; ``base_failed`` and ``kept`` are the verdicts.  A null text has no words and
    fails; documents without a host share the null host.  Lines of one text that are equal
    when normalised count once for the frequency and are all removed.  Rows that repeat an id
    are rows of their own; other columns are ignored; an empty table gives no rows.  A very long
    text takes time in proportion to its length.
    """
    rows = documents.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(host_col).cast("string").alias("host"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    lines = F.transform(
        "lines",
        lambda line: F.struct(
            F.xxhash64(normalised(line)).alias("line"), F.size(words(line)).alias("size")
        ),
    )
    rows = staged(
        base_metrics(rows).select(
            F.monotonically_increasing_id().alias("row_id"),
            "doc_id",
            "host",
            F.xxhash64("text").alias("text_key"),
            *METRICS,
            lines.alias("lines"),
        ),
        "quality-rows",
    )
    texts = rows.select("host", "text_key", F.array_distinct("lines.line").alias("lines"))
    # Copies are folded before lines are counted: each text of a host brings its lines once.
    texts = texts.groupBy("host", "text_key").agg(F.first("lines").alias("lines"))
    sizes = texts.groupBy("host").agg(F.count("*").alias("n_texts"))
    common = (
        texts.select("host", F.explode("lines").alias("line"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > max_texts)
        .join(sizes.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h")))
        .where(F.col("n") > F.col("n_texts") * max_share)
        .select(F.col("host").alias("c_host"), F.col("line").alias("c_line"))
    )
    found = (
        rows.select("row_id", "host", F.explode("lines").alias("l"))
        .select("row_id", "host", "l.line", "l.size")
        .join(common, F.col("host").eqNullSafe(F.col("c_host")) & (F.col("line") == F.col("c_line")))
        .groupBy("row_id")
        .agg(
            F.sum("size").alias("n_boilerplate_words"),
            F.sort_array(F.collect_set("line")).alias("removed"),
        )
    )
    judged = rows.drop("lines").join(found, "row_id", "left")
    judged = judged.withColumns(
        {
            "n_boilerplate_words": F.coalesce("n_boilerplate_words", F.lit(0)).cast("bigint"),
            "removed": F.coalesce("removed", F.array().cast("array<bigint>")),
        }
    )
    left = F.col("n_words") - F.col("n_boilerplate_words")
    repeated = F.lit(round(100 * max_repeated))
    failed = (F.col("n_words") < min_words) | (
        F.col("n_repeat_words") * 100 > repeated * F.col("n_words")
    )
    return judged.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (left * 100 >= F.col("n_words") * round(100 * min_left))
    ).drop("row_id")


def keep_good(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    length_col: str | None = "n_chars",
) -> DataFrame:
    """The documents that are kept, without their boilerplate lines; ``length_col`` follows."""
    verdict = (
        quality_rules(documents, id_col, text_col, host_col)
        .where("kept")
        .select(
            F.col("doc_id").alias("__id"),
            F.col("host").alias("__host"),
            F.col("text_key").alias("__text"),
            F.col("removed").alias("__removed"),
        )
        .distinct()
    )
    keyed = documents.withColumn("__key", F.xxhash64(text_col))
    same = (
        keyed[id_col].cast("bigint").eqNullSafe(F.col("__id"))
        & keyed[host_col].cast("string").eqNullSafe(F.col("__host"))
        & (F.col("__key") == F.col("__text"))
    )
    cleaned = F.array_join(
        F.filter(
            F.split(text_col, "\n"),
            lambda line: ~F.array_contains("__removed", F.xxhash64(normalised(line)))
            | ~line.rlike(r"[^\x20\x09-\x0D]"),
        ),
        "\n",
    )
    out = keyed.join(verdict, same).withColumn(
        text_col, F.when(F.size("__removed") > 0, cleaned).otherwise(F.col(text_col))
    )
    if length_col in documents.columns:
        number = documents.schema[length_col].dataType
        length = F.when(F.size("__removed") > 0, F.char_length(text_col)).otherwise(
            F.col(length_col)
        )
        out = out.withColumn(length_col, length.cast(number))
    return out.select(*documents.columns)
