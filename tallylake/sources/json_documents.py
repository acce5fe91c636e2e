"""JSON files whose root is an array of rows, read in splits.

A file is one JSON document, often on one line and of any size, so reading it whole
would put it into one task.  Instead the text source cuts it at every ``]``, which Spark
does in parallel inside one file.  Files are then read in one of two ways:

*Flat* files need no order between pieces.  If every piece has an even number of quotes,
no cut lies inside a string (the first that did would leave an odd piece before it).  If,
besides, the first piece opens two brackets, every other opens one right after a comma,
and only blank pieces follow, then each piece is exactly one row.

*Other* files (a ``]`` inside a string, nested cells, rows that are no arrays, broken
text) are read again, cut at every comma, whatever their elements are.  String state and
depth are followed inside each input split, from sums over the splits in all of the file.

No task ever sees a whole file.  Positions: ``block`` is the start of the input split and
``mid`` counts up inside it, so (file, block, mid) is the order of the text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallylake.session import scratch_dir
from tallylake.sources.json_trace import TRACE, trace_elements
from tallylake.sources.paths import file_stamps, is_hidden, literal_path
from tallylake.sources.staging import Staging

LOADED = "LOADED"
ROOT_NOT_ARRAY = "ROOT_NOT_ARRAY"
BAD_JSON = "BAD_JSON"
ELEMENT_TOO_LARGE = "ELEMENT_TOO_LARGE"

# The first reading passes over longer pieces; their file is then cut at commas.
FLAT_PIECE_BYTES = 1 << 20
# A larger element is a rejected row.  A file with so much text and no comma in it cannot
# be cut, and is rejected.
MAX_TEXT_BYTES = 1 << 27

# Strict JSON: double quotes only.
JSON_OPTIONS = {"allowSingleQuotes": "false"}
BLANKS = " \t\r\n"
# A string literal, closed or running to the end of the piece.
STRING_LITERAL = r'"[^"\\]*+(?:\\[\s\S][^"\\]*+)*+(?:"|\\?\z)'

# A file as it was listed.
STAMPS = "file string, file_size bigint, modified_ms bigint"

Typer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Documents:
    """What was read.

    ``rows``: file, pos and what the typer made of (raw, cells).
    ``files``: file, status, rows_ok, rows_rejected, file_size and modified_ms, one line
    per file that holds a byte.
    """

    rows: DataFrame
    files: DataFrame


def text_options(cut_at: str = "]") -> dict[str, str]:
    """Pieces that are too long are not held, nor sought beyond a split; sums miss them."""
    longest = FLAT_PIECE_BYTES if cut_at == "]" else MAX_TEXT_BYTES
    return {
        "lineSep": cut_at,
        "mapreduce.input.linerecordreader.line.maxlength": str(longest),
    }


def file_pattern(folder: str) -> str:
    """Files ending in .json, one directory level."""
    return f"{literal_path(folder)}/*.json"


def read_pieces(spark: SparkSession, *patterns: str, cut_at: str = "]") -> DataFrame:
    options = text_options(cut_at)
    return with_position(spark.read.format("text").options(**options).load(list(patterns)))


def with_position(df: DataFrame) -> DataFrame:
    """Columns a text scan must carry; ``mid`` is added by ``parse_documents``."""
    # Spark reports names as in a URI, where a plus sign stands for itself.
    name = F.col("_metadata.file_name")
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return df.select(
        "value",
        F.when(F.contains(name, F.lit("%")), decoded).otherwise(name).alias("file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.unix_millis("_metadata.file_modification_time").alias("modified_ms"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def read_json_rows(
    spark: SparkSession, folder: str, staging: Staging | None = None
) -> DataFrame:
    """(file, pos, cells) of every row array in the valid documents of a folder.

    ``cells`` is NULL for an element that is no array.  The rows are read from ``staging``;
    a caller that gives one clears it when the rows are no longer needed.
    """
    staging = staging or Staging(spark, scratch_dir(spark, "json-rows"))
    listed = [f for f in file_stamps(spark, file_pattern(folder)) if f[1] and not is_hidden(f[0])]
    pieces = read_pieces(spark, file_pattern(folder))
    listed = spark.createDataFrame(listed, STAMPS)
    return parse_documents(pieces, folder, staging, lambda rows: rows.drop("raw"), listed).rows


def parse_documents(
    pieces: DataFrame,
    folder: str,
    staging: Staging,
    typer: Typer,
    listed: DataFrame | None = None,
) -> Documents:
    """Parse the pieces of any number of files of one folder.

    A file whose only piece is too long gives none.  It is read where ``listed`` (columns
    ``STAMPS``) names it; ``pieces`` alone cannot tell of it.

    ``typer`` maps rows with ``raw`` (text of the element) and ``cells`` (array of
    strings, NULL if the element is no array) to the columns to keep.  Rows it gives a
    ``reason`` count as rejected.
    """
    flat = staging.put("flat", typer(_flat_rows(_with_order(pieces))))
    blocks = staging.put("blocks", _judge_flat(flat))
    kept = [c for c in flat.columns if c not in _PIECE_COLUMNS]
    starts = blocks.where("flat").select("file", "block", "first_mid", "before")
    rows = (
        flat.where(IS_ROW)
        .join(starts, ["file", "block"])
        .withColumn("pos", F.col("before") + F.col("mid") - F.col("first_mid"))
        .select("file", "pos", *kept)
    )
    files = (
        blocks.where("flat")
        .groupBy("file")
        .agg(F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected"))
        .select("file", F.lit(LOADED).alias("status"), *_counts())
    )
    flat_files = blocks.where("flat").select("file").distinct()
    if listed is None:
        stamps = blocks.groupBy("file").agg(
            F.max("file_size").alias("file_size"), F.max("modified_ms").alias("modified_ms")
        )
        others = blocks.where("NOT flat").select("file").distinct()
    else:
        stamps = listed.select("file", "file_size", "modified_ms")
        others = stamps.select("file").join(flat_files, "file", "left_anti")
    # Read again by name, so that no regular file is; names only come to the driver.
    names = [r.file for r in others.collect()]
    if names:
        cut = named_pieces(staging.spark, folder, names, cut_at=",")
        general = _general(cut, staging, typer)
        rows = rows.unionByName(general.rows.select(rows.columns))
        nothing = [F.lit(0).cast("bigint").alias(c) for c in ("rows_ok", "rows_rejected")]
        unread = others.join(general.files, "file", "left_anti")
        unread = unread.select("file", F.lit(ELEMENT_TOO_LARGE).alias("status"), *nothing)
        files = files.unionByName(general.files).unionByName(unread)
    return Documents(rows, files.join(stamps, "file"))


def no_pieces(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "value string, file string, file_size bigint, modified_ms bigint, block bigint"
    )


def named_pieces(
    spark: SparkSession, folder: str, names: list[str], cut_at: str = "]"
) -> DataFrame:
    """The pieces of some files of a folder."""
    paths = [literal_path(f"{folder.rstrip('/')}/{name}") for name in names]
    return read_pieces(spark, *paths, cut_at=cut_at)


def _with_order(pieces: DataFrame) -> DataFrame:
    return pieces.withColumn("mid", F.monotonically_increasing_id())


def _rejected(rows: DataFrame) -> Column:
    return F.col("reason").isNotNull() if "reason" in rows.columns else F.lit(False)


def _counts() -> list[Column]:
    return [
        (F.col("rows") - F.col("rejected")).alias("rows_ok"),
        F.col("rejected").alias("rows_rejected"),
    ]


# --- flat files -----------------------------------------------------------------------

IS_ROW = "kind IN ('head', 'row')"
_PIECE_COLUMNS = ("file", "file_size", "modified_ms", "block", "mid", "kind", "bytes")


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _quotes(text: Column) -> Column:
    """Quotes that open or close a string; escape sequences do not count."""
    escaped = F.contains(text, F.lit("\\"))
    return _count(
        F.when(escaped, F.regexp_replace(text, r"\\[\s\S]", "")).otherwise(text), '"'
    )


def _cells(array_text: Column) -> Column:
    return F.from_json(array_text, "array<string>", JSON_OPTIONS)


def _flat_rows(pieces: DataFrame) -> DataFrame:
    """Each piece read as if its file were flat; ``kind`` tells what it looks like."""
    value = F.col("value")
    opened = _count(value, "[")
    # Brackets inside strings do not count; looked for only where there are extra ones.
    opened = F.when(opened > 1, _count(F.regexp_replace(value, STRING_LITERAL, ""), "["))\
        .otherwise(opened)
    shape = pieces.select(
        "file",
        "file_size",
        "modified_ms",
        "block",
        "mid",
        "value",
        F.octet_length("value").alias("bytes"),
        F.btrim(value, F.lit(BLANKS)).alias("body"),
        (_quotes(value) % 2).alias("odd"),
        opened.alias("opened"),
    )
    sound = (F.col("odd") == 0) & F.is_valid_utf8("body")
    kind = (
        F.when(F.col("body") == "", "blank")
        .when(sound & (F.col("opened") == 1) & F.col("body").rlike(r"^,[ \t\r\n]*\["), "row")
        .when(sound & (F.col("opened") == 2) & F.col("body").rlike(r"^\[[ \t\r\n]*\["), "head")
        .otherwise("other")
    )
    # The row starts at the first bracket, in the first piece at the second.
    start = F.when(F.col("kind") == "row", F.expr("locate('[', body)")).when(
        F.col("kind") == "head", F.expr("locate('[', body, 2)")
    )
    text = F.concat(F.expr("substring(body, _start)"), F.lit("]"))
    rows = (
        shape.withColumn("kind", kind)
        .withColumn("_start", start)
        .withColumn("raw", F.when(F.col("_start").isNotNull(), text))
        .withColumn("cells", _cells(F.col("raw")))
    )
    broken = F.col("raw").isNotNull() & F.col("cells").isNull()
    return rows.select(
        *[c for c in _PIECE_COLUMNS if c not in ("kind", "bytes")],
        F.when(broken, "other").otherwise(F.col("kind")).alias("kind"),
        F.col("bytes").cast("bigint").alias("bytes"),
        "raw",
        "cells",
    )


def _judge_flat(flat: DataFrame) -> DataFrame:
    """One line per split: is its file flat, and how many pieces come before the split."""
    kind, mid = F.col("kind"), F.col("mid")
    is_row = F.expr(IS_ROW)
    blocks = flat.groupBy("file", "file_size", "block").agg(
        F.max("modified_ms").alias("modified_ms"),
        F.count("*").alias("n"),
        F.sum("bytes").alias("bytes"),
        F.count_if(is_row).alias("rows"),
        F.count_if(is_row & _rejected(flat)).alias("rejected"),
        F.count_if(kind == "other").alias("others"),
        F.count_if(kind == "head").alias("heads"),
        F.count_if(kind == "blank").alias("blanks"),
        F.min(mid).alias("first_mid"),
        F.min(F.when(kind == "head", mid)).alias("head_mid"),
        F.min(F.when(kind == "blank", mid)).alias("first_blank"),
        F.max(F.when(kind != "blank", mid)).alias("last_full"),
    )
    whole = Window.partitionBy("file")

    def total(name: str) -> Column:
        return F.sum(name).over(whole)

    starts = F.max((F.col("block") == 0) & (F.col("head_mid") == F.col("first_mid"))).over(whole)
    ordered = F.min(F.coalesce(F.col("last_full") < F.col("first_blank"), F.lit(True))).over(whole)
    blank_block = F.min(F.when(F.col("blanks") > 0, F.col("block"))).over(whole)
    full_block = F.max(F.when(F.col("last_full").isNotNull(), F.col("block"))).over(whole)
    # Every piece but an unfinished last one ended in a bracket of its own.  A finished
    # document leaves one blank piece between its last two brackets, and one more if
    # blanks follow.
    missing = total("n") + total("bytes") - F.col("file_size")
    closes = ((missing == 0) & (total("blanks") == 1)) | ((missing == 1) & (total("blanks") == 2))
    is_flat = (
        (total("others") == 0)
        & (total("heads") == 1)
        & starts
        & ordered
        & (blank_block >= full_block)
        & closes
    )
    return blocks.select(
        "file",
        "file_size",
        "modified_ms",
        "block",
        "first_mid",
        "rows",
        "rejected",
        _total_before(F.col("n"), _earlier("block")).alias("before"),
        F.coalesce(is_flat, F.lit(False)).alias("flat"),
    )


# --- all other files ------------------------------------------------------------------


def _earlier(*order: str, within: tuple[str, ...] = ("file",)) -> Window:
    rows = Window.partitionBy(*within).orderBy(*order)
    return rows.rowsBetween(Window.unboundedPreceding, -1)


def _total_before(amount: Column, window: Window) -> Column:
    return F.coalesce(F.sum(amount).over(window), F.lit(0))


def _general(pieces: DataFrame, staging: Staging, typer: Typer) -> Documents:
    """Files cut at every comma, in one reading (see ``json_trace``).

    The sums of the splits, one line each, tell where every split stands in its document;
    only text of elements that a split or a batch has cut is shuffled.
    """
    cut = pieces.select("value", "file", "file_size", "block")
    trace = staging.put("trace", cut.mapInArrow(trace_elements, TRACE))
    splits = _split_starts(trace.where("odd IS NOT NULL").drop("text"))
    splits = staging.put("splits", splits)
    verdicts = staging.put("verdicts", _structure(splits))
    elements = staging.put("elements", _elements(trace, splits, verdicts, typer))

    # A file with one unreadable element is rejected as a whole.
    unreadable = elements.where("broken").select("file").distinct()
    files = verdicts.join(unreadable.withColumn("bad", F.lit(True)), "file", "left").select(
        "file", F.when(F.col("bad"), BAD_JSON).otherwise(F.col("status")).alias("status")
    )
    counts = elements.groupBy("file").agg(
        F.count("*").alias("rows"), F.count_if(_rejected(elements)).alias("rejected")
    )
    loaded = F.col("status") == LOADED
    files = staging.put(
        "files",
        files.join(counts, "file", "left").select(
            "file",
            "status",
            *[F.when(loaded, F.coalesce(c, F.lit(0))).otherwise(0) for c in _counts()],
        ).toDF("file", "status", "rows_ok", "rows_rejected"),
    )
    return Documents(elements.join(_loaded(files), "file", "left_semi").drop("broken"), files)


def _split_starts(sums: DataFrame) -> DataFrame:
    """The sums of each split from its true start, with its depth and first element there."""
    whole = Window.partitionBy("file")
    state = _total_before(F.col("odd"), _earlier("block", within=("file", "start"))) % 2
    read = sums.withColumn("state", state).where(F.col("start") == F.col("state"))
    depth = _total_before(F.col("step"), _earlier("block"))
    placed = read.withColumn("depth", depth).select(
        "*",
        (F.min("block").over(whole) == F.col("block")).alias("first_split"),
        (F.max("block").over(whole) == F.col("block")).alias("last_split"),
        # Every piece but the last of the file ends in a comma.
        (F.col("file_size") + 1 - F.sum(F.col("bytes") + F.col("pieces")).over(whole))
        .alias("missing"),
    )
    ended = F.when(F.expr(AT_TOP), F.col("k")).otherwise(0)
    tail = ~F.col("last_split") & F.coalesce(F.col("after") + F.col("depth") == 1, F.lit(False))
    closed = placed.withColumn("closed", ended + tail.cast("int"))
    return closed.select(
        "*",
        _total_before(F.col("closed"), _earlier("block")).alias("base"),
        F.sum("closed").over(whole).alias("last_element"),
    )


# The record ends at, or follows, a comma between elements.
AT_TOP = "floor + depth = 1"


def _loaded(files: DataFrame) -> DataFrame:
    return files.where(F.col("status") == LOADED).select("file")


def _structure(splits: DataFrame) -> DataFrame:
    """Status of each file as far as brackets and quotes tell."""
    # The document closes once, with its last bracket, and never before.
    lowest = F.col("low") + F.col("depth")
    ends = (
        (lowest == 0)
        & (F.col("n_low") == 1)
        & (F.col("depth") + F.col("step") == 0)
        & ((F.col("state") + F.col("odd")) % 2 == 0)
    )
    sound = ~F.col("bad") & F.when(F.col("last_split"), ends).otherwise(lowest >= 1)
    sound = F.coalesce(sound, ~F.col("bad") & ~F.col("last_split"))
    facts = splits.groupBy("file").agg(
        F.bool_or(F.col("first_split") & ~F.col("opens_array")).alias("no_array"),
        F.bool_and(sound).alias("sound"),
        F.first("missing").alias("missing"),
    )
    return facts.select(
        "file",
        F.when(F.col("missing") >= MAX_TEXT_BYTES, ELEMENT_TOO_LARGE)
        .when(F.col("no_array"), ROOT_NOT_ARRAY)
        .when(F.col("sound") & (F.col("missing") == 0), LOADED)
        .otherwise(BAD_JSON)
        .alias("status"),
    )


def _elements(
    trace: DataFrame, splits: DataFrame, verdicts: DataFrame, typer: Typer
) -> DataFrame:
    """file, pos, broken and what the typer makes of (raw, cells), one line per element.

    ``broken`` marks what cannot be read.  An element no string can hold is a rejected row.
    """
    states = splits.select("file", "block", "start", "depth", "base", "last_element")
    records = (
        trace.select("file", "block", "start", "seq", "floor", "k", "whole", "size", "text")
        .join(states.join(_loaded(verdicts), "file", "left_semi"), ["file", "block", "start"])
        .withColumn("pos", F.col("base") + F.when(F.expr(AT_TOP), F.col("k")).otherwise(0))
        .withColumn("alone", F.col("whole") & F.expr(AT_TOP))
    )
    key = ["file", "pos", "last_element"]
    parts = records.where("NOT alone")
    sizes = parts.groupBy(*key).agg(F.sum(F.col("size") + 1).alias("size"))
    too_long = F.col("size") > MAX_TEXT_BYTES
    large = (
        sizes.where(F.col("size") > MAX_TEXT_BYTES)
        .select(*key)
        .unionByName(records.where(F.col("alone") & too_long).select(*key))
    )
    listed = F.sort_array(F.collect_list(F.struct("block", "seq", F.col("text").cast("string").alias("text"))))
    joined = (
        parts.join(large, key, "left_anti")
        .groupBy(*key)
        .agg(F.array_join(F.transform(listed, lambda p: p["text"]), ",").alias("text"))
    )
    texts = (
        records.where(F.col("alone") & ~too_long)
        .select(*key, F.col("text").cast("string").alias("text"))
        .unionByName(joined)
        .withColumn("large", F.lit(False))
        .unionByName(large.select(*key, F.lit(None).alias("text"), F.lit(True).alias("large")))
    )
    # The brackets of the document itself.
    first, last = F.col("pos") == 0, F.col("pos") == F.col("last_element")
    bodies = (
        texts.withColumn("body", F.btrim("text", F.lit(BLANKS)))
        .withColumn("body", F.when(first, F.expr("substring(body, 2)")).otherwise(F.col("body")))
        .withColumn("body", F.when(last, F.expr("left(body, length(body) - 1)")).otherwise(F.col("body")))
        .withColumn("body", F.btrim("body", F.lit(BLANKS)))
        # Nothing but blanks may follow the bracket that closes the document.
        .withColumn("sound", F.is_valid_utf8("text") & (~last | F.endswith(F.rtrim("text", F.lit(BLANKS)), F.lit("]"))))
        .where(F.col("large") | ~(first & last & (F.col("body") == "") & F.col("sound")))
    )
    boxed = F.concat(F.lit("["), F.col("body"), F.lit("]"))
    is_array = F.startswith("body", F.lit("["))
    as_array = F.from_json(boxed, "array<array<string>>", JSON_OPTIONS)
    read = bodies.select(
        "file",
        "pos",
        "large",
        "sound",
        "body",
        is_array.alias("is_array"),
        F.when(is_array, as_array).alias("arrays"),
        F.when(~is_array, _cells(boxed)).alias("values"),
    )
    one = F.when(F.col("is_array"), F.size("arrays") == 1).otherwise(F.size("values") == 1)
    one = one & F.col("sound") & (~F.col("is_array") | F.expr("get(arrays, 0)").isNotNull())
    typed = typer(
        read.select(
            "file",
            "pos",
            "large",
            (~F.col("large") & ~F.coalesce(one, F.lit(False))).alias("broken"),
            F.when(F.col("is_array"), F.col("body"))
            .otherwise(F.coalesce(F.expr("get(values, 0)"), F.lit("null")))
            .alias("raw"),
            F.expr("get(arrays, 0)").alias("cells"),
        )
    )
    if "reason" in typed.columns:
        reason = F.when(F.col("large"), ELEMENT_TOO_LARGE).otherwise(F.col("reason"))
        typed = typed.withColumn("reason", reason)
    return typed.drop("large")
