"""Incremental, exactly-once loading of JSON files.

The stream hands out every new name once.  Files it could not load (broken, empty, or of
a name Spark passes over) are noted in the audit with their size and time of change; once
these differ, the next run loads them in a commit of its own.  Commits are numbered so
that those between two batches of the stream lie between their numbers.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.functions.cells import type_cells
from tallylake.schema import CELLS
from tallylake.session import scratch_dir
from tallylake.sources import tables
from tallylake.sources.json_documents import (
    LOADED,
    STAMPS,
    file_pattern,
    named_pieces,
    no_pieces,
    parse_documents,
    text_options,
    with_position,
)
from tallylake.sources.paths import file_stamps, is_hidden
from tallylake.sources.staging import Staging

EMPTY_FILE = "EMPTY_FILE"
HIDDEN_NAME = "HIDDEN_NAME"
# Numbers of commits from one batch of the stream to the next.
COMMITS_PER_BATCH = 1 << 20


@dataclass(frozen=True)
class IngestSummary:
    batches: int
    files: int
    rows_ok: int
    rows_rejected: int
    seconds: float

    @property
    def rows_per_second(self) -> float:
        return self.rows_ok / self.seconds if self.seconds else 0.0


def ingest_new(
    spark: SparkSession,
    folder: str,
    root: str,
    checkpoint: str | None = None,
    null_as_text: bool = False,
    max_bytes_per_batch: str | None = None,
    version: int | None = None,
) -> IngestSummary:
    """Load the files of ``folder`` whose names were not loaded before.

    The stream's checkpoint holds the names it has seen.  A failed run is repeated with the
    same files under the same batch number and replaces what it had written.  A file that
    was rejected or empty, and has changed since, is loaded as well.
    ``max_bytes_per_batch`` splits a large load into several commits.  ``version``
    is the stamp of the rows, by default the current second.
    """
    started = time.time()
    stamp = int(started) if version is None else version
    checkpoint = checkpoint or f"{root}/_checkpoints/ingest"
    staging_folder = scratch_dir(spark, "ingest")
    source = (
        spark.readStream.format("text")
        .options(**text_options())
        # A name counts as loaded whatever its folder or age.
        .option("fileNameOnly", "true")
        .option("maxFileAge", "36500d")
    )
    if max_bytes_per_batch:
        source = source.option("maxBytesPerTrigger", max_bytes_per_batch)
    done: list[int] = []
    # Before the stream lists the folder, so that it has seen whatever is listed here.
    listed = file_stamps(spark, file_pattern(folder))
    tables.remove_uncommitted_notes(spark, root)

    def load(batch: DataFrame, batch_id: int) -> None:
        staging = Staging(batch.sparkSession, staging_folder)
        seq = (batch_id + 1) * COMMITS_PER_BATCH
        _load_batch(batch, seq, folder, root, staging, stamp, null_as_text)
        done.append(seq)

    query = (
        with_position(source.load(file_pattern(folder)))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
        staging = Staging(spark, staging_folder)
        most = _bytes_of(spark, max_bytes_per_batch)
        done += _load_left(listed, folder, root, staging, stamp, null_as_text, most)
    finally:
        Staging(spark, staging_folder).clear()
    return _summary(spark, root, done, time.time() - started)


def _load_left(
    listed: list[tuple[str, int, int]],
    folder: str,
    root: str,
    staging: Staging,
    stamp: int,
    null_as_text: bool,
    max_bytes: int | None,
) -> list[int]:
    """Load or note the listed files the stream has seen and never loaded.

    Returns the numbers of the commits, each of files of ``max_bytes`` or of one larger file.
    A run that fails here keeps the commits it has made, and the next finds the other files.
    """
    spark = staging.spark
    seen = spark.createDataFrame(
        [(name, size, modified, is_hidden(name)) for name, size, modified in listed],
        "file string, file_size bigint, modified_ms bigint, hidden boolean",
    )
    known = tables.latest_audit(spark, root).select(
        "file",
        "status",
        F.col("file_size").alias("known_size"),
        F.col("modified_ms").alias("known_ms"),
    )
    same = F.col("file_size").eqNullSafe(F.col("known_size")) & F.col("modified_ms").eqNullSafe(
        F.col("known_ms")
    )
    # A listed file without a line in the audit gave the stream nothing: it was empty, hidden,
    # or one piece too long to be held.
    left = seen.join(known, "file", "left").where(
        F.col("status").isNull() | ((F.col("status") != LOADED) & ~same)
    )
    # Fewer than were listed, and these are on the driver.
    left = sorted(tuple(r) for r in left.select(*seen.columns).collect())
    if not left:
        return []
    noted = spark.createDataFrame(
        [(*row, HIDDEN_NAME if hidden else EMPTY_FILE) for *row, hidden in left if hidden or not row[1]],
        "file string, file_size bigint, modified_ms bigint, status string",
    )
    again = {row[0]: tuple(row) for *row, hidden in left if row[1] and not hidden}
    groups = _by_bytes([(name, size) for name, size, _ in again.values()], max_bytes)
    done = []
    for group in groups or [[]]:
        seq = tables.last_seq(spark, tables.transactions(root)) + 1
        if seq and seq % COMMITS_PER_BATCH == 0:
            raise ValueError(f"too many loads of mended files between two batches of {root}")
        pieces = named_pieces(spark, folder, group) if group else None
        own = spark.createDataFrame([again[name] for name in group], STAMPS)
        # Files that cannot be read are noted with the first commit.
        first = None if done else noted
        _load_batch(pieces, seq, folder, root, staging, stamp, null_as_text, own, first)
        done.append(seq)
    return done


def _bytes_of(spark: SparkSession, size: str | None) -> int | None:
    """What Spark takes a size such as ``10m`` to be."""
    if not size:
        return None
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(str(size))


def _by_bytes(sized: list[tuple[str, int]], max_bytes: int | None) -> list[list[str]]:
    """Files in their order, in groups of at most so many bytes or of one larger file."""
    groups: list[list[str]] = []
    room = 0
    for name, size in sized:
        if not groups or max_bytes is not None and size > room:
            groups.append([])
            room = max_bytes or 0
        groups[-1].append(name)
        room -= size
    return groups


def _load_batch(
    batch: DataFrame | None,
    batch_id: int,
    folder: str,
    root: str,
    staging: Staging,
    stamp: int,
    null_as_text: bool,
    listed: DataFrame | None = None,
    noted: DataFrame | None = None,
) -> None:
    """Load the pieces of some files, and note files that cannot be read, in one commit."""
    facts = tables.transactions(root)
    if tables.is_committed(staging.spark, facts, batch_id):
        # The run before stopped after the commit and before the checkpoint noted it.
        _same_files(batch, batch_id, root, staging.spark)
        return
    if batch is None:
        batch = no_pieces(staging.spark)
    documents = parse_documents(
        batch, folder, staging, lambda rows: type_cells(rows, null_as_text), listed
    )
    rows, files = documents.rows, documents.files
    if noted is not None:
        nothing = [F.lit(0).cast("bigint").alias(c) for c in ("rows_ok", "rows_rejected")]
        noted = noted.select("file", "status", *nothing, "file_size", "modified_ms")
        files = files.unionByName(noted)

    bad_rows = rows.where("reason IS NOT NULL").select("file", "pos", "raw", "reason")
    bad_files = files.where(F.col("status") != LOADED).select(
        "file",
        F.lit(None).cast("bigint").alias("pos"),
        F.lit(None).cast("string").alias("raw"),
        F.col("status").alias("reason"),
    )
    tables.write_commit(bad_rows.unionByName(bad_files), tables.rejects(root), batch_id)

    tables.write_commit(files, tables.ingest_audit(root), batch_id)

    # Last, so that the marker of the facts commits the whole batch.
    good = rows.where("reason IS NULL").select(
        *CELLS,
        F.lit(stamp).cast("bigint").alias("_version"),
        F.col("file").alias("source_file"),
        F.col("pos").alias("source_pos"),
    )
    tables.write_transactions(good, root, batch_id)


def _same_files(batch: DataFrame, batch_id: int, root: str, spark: SparkSession) -> None:
    """A new checkpoint over an old table would skip its files; refuse instead."""
    loaded = tables.read_table(spark, tables.ingest_audit(root))
    known = loaded.where(F.col("batch_id") == batch_id).select("file")
    if not batch.select("file").distinct().join(known, "file", "left_anti").isEmpty():
        raise ValueError(f"batch {batch_id} of {root} was loaded from other files")


def _summary(spark: SparkSession, root: str, batches: list[int], seconds: float) -> IngestSummary:
    files = ok = rejected = 0
    if batches:
        audit = tables.audited_files(spark, root)
        files, ok, rejected = (
            audit.where(F.col("batch_id").between(min(batches), max(batches)))
            .agg(F.count("*"), F.sum("rows_ok"), F.sum("rows_rejected"))
            .first()
        )
    return IngestSummary(len(batches), files, ok or 0, rejected or 0, seconds)
