"""SimHash near-duplicates by a binary trie joined with itself.

The 64 bits of a fingerprint are four blocks of 16.  Two fingerprints that differ in at most
three bits agree in a whole block, so there are four tries, the bits turned so that another
block leads in each.  In a trie only nodes that agree in the leading block are paired; from
there pairs of nodes are traversed together down to the leaves: differing bits add up and a
pair goes as soon as they exceed the budget.

The nodes under one leading block are a *unit*, the piece of work that a task gets.  A unit of
more than ``unit_rows`` fingerprints is cut by its next eight bits into pairs of subtrees that
the budget still allows, over and over until all are small.  Only distinct fingerprints enter.
A unit gives back a spanning forest of its links, never all its pairs, and subtrees that are
known to be connected are not paired again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.llm.common import row_numbers, staged

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
UNIT_ROWS = 50_000

BLOCK_BITS = 16
CUT_BITS = 8
SHINGLES_AT_ONCE = 100_000
PAIRS_AT_ONCE = 500_000
ROWS_AT_ONCE = 200_000

# How the two sides of a unit are told apart.
WITHIN, LEFT, RIGHT = 0, 1, 2


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text; zero if it has no word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    last = max(1, len(words) - shingle_words + 1)
    votes = np.zeros(64, dtype=np.int64)
    for start in range(0, last, SHINGLES_AT_ONCE):
        part = words[start : min(start + SHINGLES_AT_ONCE, last) + shingle_words - 1]
        if len(part) <= shingle_words:
            shingles = [b" ".join(part)]
        else:
            shingles = map(b" ".join, zip(*(part[i:] for i in range(shingle_words))))
        digests = b"".join([xxhash.xxh64_digest(s, SEED) for s in shingles])
        bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8)).reshape(-1, 64)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > last).tobytes(), "big")


def fingerprints(
    documents: DataFrame, id_col: str, text_col: str, shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """Rows (row_id, doc_id, text_key, fp), one per row of ``documents``, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = row_numbers()
        for batch in batches:
            texts = batch.column(2)
            found = np.fromiter(
                (fingerprint(t.as_py(), shingle_words) for t in texts), np.uint64, len(texts)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([next(numbers) for _ in range(len(texts))], pa.int64()),
                    batch.column(0),
                    batch.column(1),
                    pa.array(found.view(np.int64), pa.int64()),
                ],
                ["row_id", "doc_id", "text_key", "fp"],
            )

    rows = documents.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.xxhash64(text_col).alias("text_key"),
        F.col(text_col).cast("string").alias("text"),
    )
    schema = "row_id bigint, doc_id bigint, text_key bigint, fp bigint"
    return staged(rows.mapInArrow(run, schema), "simhash-rows")


# --- the trie join --------------------------------------------------------------------


def _turned(fp: Column, bits: int) -> Column:
    if not bits:
        return fp
    return F.shiftleft(fp, bits).bitwiseOR(F.shiftrightunsigned(fp, 64 - bits))


def _units(fps: DataFrame, max_bits: int, unit_rows: int) -> DataFrame:
    """The work: rows (unit, side, depth, budget, turn, key), every unit small."""
    turns = [F.struct(F.lit(t).alias("turn"), _turned(F.col("fp"), t).alias("key"))
             for t in range(0, 64, BLOCK_BITS)]
    rows = fps.select(F.explode(F.array(*turns)).alias("t")).select(
        F.xxhash64("t.turn", F.shiftrightunsigned("t.key", 64 - BLOCK_BITS)).alias("unit"),
        F.lit(WITHIN).alias("side"),
        F.lit(BLOCK_BITS).alias("depth"),
        F.lit(max_bits).alias("budget"),
        "t.turn",
        "t.key",
    )
    done = []
    while True:
        rows = staged(rows, "simhash-units")
        large = staged(
            rows.groupBy("unit").count().where(F.col("count") > unit_rows).select("unit"),
            "simhash-large",
        )
        if large.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(large, "unit", "left_anti").select(rows.columns))
        rows = _cut(rows.join(large, "unit", "left_semi"))
    units = done[0]
    for more in done[1:]:
        units = units.unionByName(more)
    return units


def _cut(rows: DataFrame) -> DataFrame:
    """Large units as the pairs of their subtrees, eight bits deeper."""
    masks = F.array(*[F.lit(m) for m in range(1 << CUT_BITS)])
    near = F.filter(masks, lambda m: F.bit_count(m) <= F.col("budget"))
    # A unit all of whose bits are used holds one fingerprint a side; it is never large.
    own = F.shiftrightunsigned(F.expr("shiftleft(key, depth)"), 64 - CUT_BITS).cast("int")
    pairs = rows.withColumn("own", own).withColumn("mask", F.explode(near))
    other = F.col("own").bitwiseXOR(F.col("mask"))
    within = F.col("side") == WITHIN
    left = F.when(within, F.least("own", other)).when(
        F.col("side") == LEFT, F.col("own")).otherwise(other)
    right = F.when(within, F.greatest("own", other)).when(
        F.col("side") == LEFT, other).otherwise(F.col("own"))
    side = (
        F.when(~within, F.col("side"))
        .when(F.col("mask") == 0, WITHIN)
        .when(F.col("own") == left, LEFT)
        .otherwise(RIGHT)
    )
    return pairs.select(
        F.xxhash64("unit", left, right).alias("unit"),
        side.alias("side"),
        (F.col("depth") + CUT_BITS).alias("depth"),
        (F.col("budget") - F.bit_count("mask")).alias("budget"),
        "turn",
        "key",
    )


class _Forest:
    """Components of positions 0..n-1 that grow by links."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self._changes()

    def _changes(self) -> None:
        steps = np.zeros(len(self.label) + 1, dtype=np.int64)
        steps[1:-1] = self.label[1:] != self.label[:-1]
        self.changes = np.cumsum(steps)

    def link(self, x: np.ndarray, y: np.ndarray) -> None:
        label, grown = self.label, False
        while True:
            a, b = label[x], label[y]
            apart = a != b
            if not apart.any():
                break
            x, y, a, b = x[apart], y[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label = up
            grown = True
        self.label = label
        if grown:
            self._changes()

    def joined(self, alo, ahi, blo, bhi) -> np.ndarray:
        """Whether all positions of both ranges are one component."""
        c = self.changes
        return (
            (c[ahi - 1] == c[alo]) & (c[bhi - 1] == c[blo]) & (self.label[alo] == self.label[blo])
        )


def trie_links(unit, side, depth, budget, key, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (position, position) that connect whatever is within ``max_bits`` in a unit."""
    order = np.lexsort((key, side, unit))
    unit, side, depth, budget, key = (x[order] for x in (unit, side, depth, budget, key))
    n = len(key)
    first = np.ones(n, dtype=bool)
    first[1:] = (unit[1:] != unit[:-1]) | (side[1:] != side[:-1])
    lo = np.flatnonzero(first)
    hi = np.append(lo[1:], n)
    kind = side[lo]
    own = np.flatnonzero(kind == WITHIN)
    left = np.flatnonzero(kind[:-1] == LEFT)
    left = left[(kind[left + 1] == RIGHT) & (unit[lo[left]] == unit[lo[left + 1]])]
    a, b = np.concatenate([left, own]), np.concatenate([left + 1, own])
    # A pair of nodes: the two ranges of positions, the depth, the differing bits so far.
    pairs = np.stack([lo[a], hi[a], lo[b], hi[b], depth[lo[a]], max_bits - budget[lo[a]]])
    ones = np.zeros((64, n + 1), dtype=np.int32)
    for bit in range(64):
        np.cumsum((key >> np.uint64(63 - bit)) & np.uint64(1), out=ones[bit, 1:])
    forest = _Forest(n)
    stack = [pairs]
    while stack:
        pairs = stack.pop()
        if pairs.shape[1] > PAIRS_AT_ONCE:
            stack.append(pairs[:, :-PAIRS_AT_ONCE])
            pairs = pairs[:, -PAIRS_AT_ONCE:]
        alo, ahi, blo, bhi, level, diff = pairs
        leaf = (ahi - alo == 1) & (bhi - blo == 1)
        x, y = alo[leaf], blo[leaf]
        close = np.bitwise_count(key[x] ^ key[y]) <= max_bits
        forest.link(x[close], y[close])
        pairs = pairs[:, ~leaf & ~forest.joined(alo, ahi, blo, bhi)]
        if not pairs.shape[1]:
            continue
        alo, ahi, blo, bhi, level, diff = pairs
        amid = ahi - (ones[level, ahi] - ones[level, alo])
        bmid = bhi - (ones[level, bhi] - ones[level, blo])
        same = alo == blo
        cross = [
            np.stack([alo, amid, bmid, bhi, level + 1, diff + 1]),
            np.stack([amid, ahi, blo, bmid, level + 1, diff + 1])[:, ~same],
        ]
        equal = [
            np.stack([alo, amid, blo, bmid, level + 1, diff]),
            np.stack([amid, ahi, bmid, bhi, level + 1, diff]),
        ]
        # What agrees is taken first: it links neighbours, and the rest is pruned by that.
        for grown in (np.concatenate(cross, axis=1), np.concatenate(equal, axis=1)):
            kept = (grown[5] <= max_bits) & (grown[0] < grown[1]) & (grown[2] < grown[3])
            stack.append(grown[:, kept])
    child = np.flatnonzero(forest.label != np.arange(n))
    return order[child], order[forest.label[child]]


def links(fps: DataFrame, max_bits: int = MAX_BITS, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """Rows (a, b) whose components are those of all fingerprints within ``max_bits``."""
    if not 0 <= max_bits < 64 // BLOCK_BITS:
        raise ValueError("the four blocks prove agreement for up to 3 bits only")
    columns = ["unit", "side", "depth", "budget", "turn", "key"]

    def found(part: pa.Table) -> Iterator[pa.RecordBatch]:
        unit, side, depth, budget, turn, key = (
            part.column(c).to_numpy() for c in columns
        )
        key = key.view(np.uint64)
        x, y = trie_links(unit, side, depth, budget, key, max_bits)
        turn = turn.astype(np.uint64)
        back = np.uint64(64) - turn
        plain = np.where(turn == 0, key, (key >> turn) | (key << (back % np.uint64(64))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(plain[x].view(np.int64)), pa.array(plain[y].view(np.int64))], ["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) < ROWS_AT_ONCE:
                continue
            rows = pa.Table.from_batches(held)
            unit = rows.column("unit").to_numpy()
            # The last unit may go on in the next batch.
            whole = int(np.argmax(unit == unit[-1]))
            if whole:
                yield from found(rows.slice(0, whole))
                held = rows.slice(whole).combine_chunks().to_batches()
        if held:
            yield from found(pa.Table.from_batches(held))

    units = _units(fps, max_bits, unit_rows)
    dealt = units.repartition("unit").sortWithinPartitions("unit")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


# --- components -----------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (a, b); root is the smallest reachable.

    Large and small stars in turn; every round is written.  A hub's edges are never gathered:
    its smallest neighbour is found by an aggregate and joined back.
    """
    edges = _lowered(staged(edges, "components"))
    state = None
    while True:
        edges = staged(_small_star(_large_star(edges)), "components")
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == state:
            break
        state = now
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return staged(members.unionByName(roots), "components")


def _lowered(edges: DataFrame) -> DataFrame:
    """Every edge once, from the larger to the smaller node."""
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("v"))
    return _lowered(larger.join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _lowered(moved.unionByName(least.select("a", F.col("m").alias("b"))))


# --- the operator ---------------------------------------------------------------------


def near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    unit_rows: int = UNIT_ROWS,
) -> DataFrame:
    """One row per row of ``documents``: doc_id, text_key, fingerprint, component_id, group_fp.

    ``component_id`` is the smallest id reachable through links, ``group_fp`` a key of the
    component that is there even if all its ids are null.  A null text is an empty one; texts
    without words have fingerprint zero and link like any other.  Rows that repeat an id or a
    text are rows of their own.  Null ids never become a component's id unless there is no
    other.  Other columns are ignored; an empty table gives no rows.
    """
    rows = fingerprints(documents, id_col, text_col, shingle_words)
    first = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    member = components(links(first.select("fp"), max_bits, unit_rows))
    known = first.join(member, first.fp == member.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("group_fp")
    )
    least = known.groupBy("group_fp").agg(F.min("first_id").alias("component_id"))
    known = staged(known.join(least, "group_fp").select("fp", "group_fp", "component_id"),
                   "simhash-known")
    return rows.join(known, "fp").select(
        "doc_id",
        "text_key",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "group_fp",
    )


def keep_first(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``documents`` without near-duplicates: the smallest id of each stays.

    Of rows with the same smallest id the one whose text has the smallest hash stays, and of
    rows that agree in both, one.  A null id counts as larger than any other.
    """
    found = near_duplicates(documents, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    kept = found.groupBy("group_fp").agg(F.min(order).alias("k")).select(
        F.col("k.doc_id").alias("__id"), F.col("k.text_key").alias("__text")
    )
    keyed = documents.withColumn("__key", F.xxhash64(text_col))
    same = keyed[id_col].cast("bigint").eqNullSafe(F.col("__id")) & (
        F.col("__key") == F.col("__text")
    )
    return (
        keyed.join(kept, same, "left_semi")
        .dropDuplicates([id_col, "__key"])
        .select(*documents.columns)
    )
