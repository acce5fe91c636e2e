"""Hard negatives by coordinate pruning of length buckets.

Vectors are scaled to integers and ordered by length, the longest first.  A block is a range of
that order; in a block, buckets of rows of similar length hold a sorted list of every coordinate
of their unit vectors.  An anchor looks for rows whose inner product reaches a threshold: a
bucket whose longest row is too short is passed over, and for the anchor's largest (focus)
coordinates the threshold leaves a feasible range of the row's coordinate, which is a range of
the sorted list.  Rows in the ranges of all focus coordinates are verified by their exact integer
product.  The threshold rises with what was found, so later buckets are cut more.

The search runs twice over all blocks: first for the nearest rows of the anchor's own label,
then for rows of other labels whose score lies in a window under each positive's score.  A task
holds one block, of bounded rows; anchors stream past it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallylake.llm.common import staged
from tallylake.operators.ordering import place_rows

POSITIVES = 5
NEGATIVES = 3
#: A negative's score lies between these hundredths of the positive's.
LOWEST, HIGHEST = 50, 95
SCALE = 256

BLOCK_ROWS = 100_000
BUCKET_ROWS = 2_048
#: A bucket ends where rows are shorter than this share of its longest.
BUCKET_SHRINK = 0.9
FOCUS = 4
#: Squared lengths stay below this, so every inner product is a 64-bit integer.
MAX_SQUARE = float(2**62)
#: Widening of feasible ranges, far above the rounding of unit vectors.
SLACK = 1e-9


class Bucket:
    """Rows of similar length, longest first, with the sorted coordinates of their unit vectors."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray, lengths: np.ndarray):
        self.rows = rows
        self.vectors = vectors[rows]
        self.longest = float(lengths[rows[0]])
        self.empty = self.longest == 0
        if not self.empty:
            # Rows without length, if any, end the last bucket; their unit vector is zero.
            unit = self.vectors / np.maximum(lengths[rows], 1e-300)[:, None]
            self.unit = unit
            self.order = np.argsort(unit, axis=0, kind="stable")
            self.sorted = np.take_along_axis(unit, self.order, axis=0)

    def candidates(self, unit: np.ndarray, focus: np.ndarray, least: float) -> np.ndarray | None:
        """Rows of the bucket that may reach ``least``; None for all of them.

        ``unit`` is the anchor's unit vector, ``least`` the threshold over both lengths: a row
        shorter than the longest needs an even larger cosine, so it is feasible for all.
        """
        if self.empty or least <= 0:
            return None
        least = min(least, 1.0)
        chosen, smallest = [], None
        for f in focus.tolist():
            x = float(unit[f])
            low, high = _feasible(x, least)
            a = int(np.searchsorted(self.sorted[:, f], low, side="left"))
            b = int(np.searchsorted(self.sorted[:, f], high, side="right"))
            chosen.append((f, low, high))
            if smallest is None or b - a < smallest[2] - smallest[1]:
                smallest = (f, a, b)
        f, a, b = smallest
        if b - a > len(self.rows) // 2:
            return None
        found = self.order[a:b, f]
        for g, low, high in chosen:
            if g != f:
                values = self.unit[found, g]
                found = found[(values >= low) & (values <= high)]
        return found


def _feasible(x: float, least: float) -> tuple[float, float]:
    """Between which values a unit vector's coordinate lies whose cosine reaches ``least``.

    With ``x`` the anchor's coordinate and ``y`` the row's, the rest of both vectors adds at most
    sqrt(1 - x²) sqrt(1 - y²); the ends are the angle of x plus and minus that of the threshold.
    """
    turn = np.sqrt(max(0.0, (1 - least * least) * (1 - x * x)))
    low = -1.0 if -x > least else x * least - turn
    high = 1.0 if x > least else x * least + turn
    return low - SLACK, high + SLACK


def cut_buckets(rows: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """``rows``, longest first, cut at a number of rows or where lengths have shrunk."""
    buckets, start = [], 0
    while start < len(rows):
        own = lengths[rows[start : start + BUCKET_ROWS]]
        size = int(np.searchsorted(-own, -own[0] * BUCKET_SHRINK, side="right"))
        buckets.append(rows[start : start + size])
        start += size
    return buckets


class Block:
    """The rows of a block and their buckets, by label or of all rows, made when first needed."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        square = np.square(vectors.astype(np.float64)).sum(axis=1)
        order = np.lexsort((rows, -square))
        self.rows, self.ids, self.labels = rows[order], ids[order], labels[order]
        self.lengths = np.sqrt(square[order])
        # Products are exact in doubles while squared lengths are, and in integers beyond.
        self.exact = len(square) == 0 or square.max() < 2**52
        self.vectors = vectors[order].astype(np.float64 if self.exact else np.int64)
        self.width = vectors.shape[1]
        self._buckets: dict[int | None, list[Bucket]] = {}
        by_label = np.argsort(self.labels, kind="stable")
        known, first = np.unique(self.labels[by_label], return_index=True)
        self._of_label = dict(zip(known.tolist(), np.split(by_label, first[1:])))

    def buckets(self, label: int | None) -> list[Bucket]:
        if label not in self._buckets:
            rows = (
                np.arange(len(self.rows))
                if label is None
                else self._of_label.get(label, np.zeros(0, dtype=np.int64))
            )
            self._buckets[label] = [
                Bucket(part, self.vectors, self.lengths) for part in cut_buckets(rows, self.lengths)
            ]
        return self._buckets[label]

    def found(
        self, vector: np.ndarray, label: int | None, threshold: Callable[[], float]
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, scores) of every bucket that may hold rows of at least ``threshold()``."""
        length = float(np.sqrt(np.square(vector.astype(np.float64)).sum()))
        double = self.exact and length < 2**26
        unit = vector / length if length else np.zeros(self.width)
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        for bucket in self.buckets(label):
            reach, least = length * bucket.longest, threshold()
            if least > reach * (1 + SLACK) + SLACK:
                break
            chosen = bucket.candidates(unit, focus, least / reach - SLACK) if reach else None
            if chosen is None:
                chosen = slice(None)
            elif not len(chosen):
                continue
            if double:
                scores = (bucket.vectors[chosen] @ vector.astype(np.float64)).astype(np.int64)
            else:
                scores = bucket.vectors[chosen].astype(np.int64) @ vector
            yield bucket.rows[chosen], scores


def _best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` by score, largest first, then id, then row."""
    if len(scores) > 4 * count:
        least = np.partition(scores, len(scores) - count)[len(scores) - count]
        keep = np.flatnonzero(scores >= least)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((rows[keep], ids[keep], -scores[keep]))[:count]]


class _Leaders:
    """The best rows so far."""

    def __init__(self, count: int):
        self.count = count
        self.scores, self.ids, self.rows = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def add(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids, rows = np.concatenate([self.ids, ids]), np.concatenate([self.rows, rows])
        at = _best(scores, ids, rows, self.count)
        self.scores, self.ids, self.rows = scores[at], ids[at], rows[at]

    def least(self, floor: float) -> float:
        """What a row must reach to come among the best, if it reaches ``floor``."""
        return max(floor, float(self.scores[-1])) if len(self.scores) == self.count else floor


def nearest_of_label(
    block: Block, row: int, label: int, vector: np.ndarray, count: int
) -> list[tuple[int, int, int]]:
    """(row, vec_id, score) of the block's best rows of a label, but for the anchor itself."""
    best = _Leaders(count)
    for at, scores in block.found(vector, label, lambda: best.least(-np.inf)):
        other = block.rows[at] != row
        at = at[other]
        best.add(scores[other], block.ids[at], block.rows[at])
    return list(zip(best.rows.tolist(), best.ids.tolist(), best.scores.tolist()))


def below_positives(
    block: Block, label: int, vector: np.ndarray, positive_scores: list[int], count: int
) -> list[list[tuple[int, int, int]]]:
    """For each positive (row, vec_id, score) of the block's best rows of other labels."""
    # Floor division: 50 p <= 100 n and 100 n <= 95 p.
    windows = [(-(-LOWEST * p // 100), HIGHEST * p // 100) for p in positive_scores]
    best = [_Leaders(count) for _ in windows]
    open_ = [i for i, (low, high) in enumerate(windows) if low <= high]
    if open_:

        def threshold() -> float:
            return min(best[i].least(windows[i][0]) for i in open_)

        for at, scores in block.found(vector, None, threshold):
            other = (block.labels[at] != label) & (scores >= threshold())
            at, scores = at[other], scores[other]
            for i in open_:
                low, high = windows[i]
                within = (scores >= low) & (scores <= high)
                if within.any():
                    own = at[within]
                    best[i].add(scores[within], block.ids[own], block.rows[own])
    return [list(zip(b.rows.tolist(), b.ids.tolist(), b.scores.tolist())) for b in best]


# --- the search in Spark --------------------------------------------------------------


def scaled_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Rows that take part: (row, vec_id, label, vector, square), integer vectors."""
    numbers = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.col(vector_col).cast("array<double>").alias("x"),
    )
    whole = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(np.inf)))
    numbers = numbers.where("vec_id is not null and label is not null and x is not null")
    numbers = numbers.where(whole)
    scaled = F.transform("x", lambda x: F.floor(x * SCALE))
    square = F.aggregate(
        "vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")
    )
    numbers = numbers.select("vec_id", "label", scaled.alias("vector"))
    return numbers.withColumn("square", square).where(F.col("square") < MAX_SQUARE)


def _search(
    rows: DataFrame,
    anchors: DataFrame,
    blocks: int,
    extra: str,
    search: Callable[[Block, int, int, np.ndarray, list[int] | None], Iterator[tuple]],
    schema: str,
) -> DataFrame:
    """``search`` of every anchor in every block.

    The rows of a block and, after them, a copy of each anchor go to one task; it holds the
    block and passes anchors by, batch after batch.
    """
    members = rows.select("block", F.lit(0).alias("kind"), "row", "vec_id", "label", "vector")
    copies = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.lit(1).alias("kind"),
        "row",
        "vec_id",
        "label",
        "vector",
        *([extra] if extra else []),
    )
    dealt = members.unionByName(copies, allowMissingColumns=True)
    dealt = dealt.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "kind")
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        number, block = None, None
        for batch in batches:
            found: list[tuple] = []
            for part in _runs(batch):
                this, kind = part.column("block")[0].as_py(), part.column("kind")[0].as_py()
                if this != number:
                    number, block, held = this, None, []
                if kind == 0:
                    held.append(part)
                    continue
                if block is None:
                    block, held = _block_of(held), []
                for anchor in part.to_pylist():
                    vector = np.zeros(max(block.width, len(anchor["vector"])), dtype=np.int64)
                    vector[: len(anchor["vector"])] = anchor["vector"]
                    # Where a row has fewer components than another, the missing ones are zero.
                    vector = vector[: block.width]
                    hits = search(block, anchor["row"], anchor["label"], vector, anchor.get(extra))
                    found += [(anchor["row"], anchor["vec_id"], *hit) for hit in hits]
            columns = list(zip(*found)) if found else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return dealt.mapInArrow(run, schema)


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch cut where block or kind changes."""
    if not batch.num_rows:
        return
    block = batch.column("block").to_numpy(zero_copy_only=False)
    kind = batch.column("kind").to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
    bounds = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(bounds, bounds[1:]):
        yield batch.slice(a, b - a)


def _block_of(parts: list[pa.RecordBatch]) -> Block:
    columns = []
    for name in ("row", "vec_id", "label"):
        own = [p.column(name).to_numpy(zero_copy_only=False) for p in parts]
        columns.append(np.concatenate(own).astype(np.int64) if own else np.zeros(0, dtype=np.int64))
    sizes = [np.asarray(p.column("vector").value_lengths()) for p in parts]
    width = max((int(s.max()) for s in sizes), default=0)
    vectors = np.zeros((len(columns[0]), width), dtype=np.int64)
    at = 0
    for part, size in zip(parts, sizes):
        flat = part.column("vector").flatten().to_numpy(zero_copy_only=False)
        inside = np.arange(width) < size[:, None]
        vectors[at : at + len(size)][inside] = flat
        at += len(size)
    return Block(*columns, vectors)


def _ranked(found: DataFrame, keys: list[str], prefix: str, count: int, rank: str) -> DataFrame:
    order = [F.col(f"{prefix}_score").desc(), f"{prefix}_id", f"{prefix}_row"]
    ranked = found.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) <= count)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components are scaled by 256 and floored; a score is the integer inner product.  Anchors are
    the rows for which ``is_anchor`` (over ``vec_id``) holds.  Higher scores come first, ties by
    smaller id.  An anchor's positives are its first ``positives`` other rows of its label; for
    each, the first ``negatives`` rows of other labels are returned whose score is at least 50 and
    at most 95 hundredths of the positive's.  A positive below zero has no such rows.

    Rows without id, label or vector, with a null or non-finite component, or so long that a
    product would not fit 64 bits, take no part.  A vector with fewer components than another
    has zeros in their place.  Repeated rows are rows of their own, told apart by an inner row
    number; other columns are ignored; an empty table gives no rows.
    """
    scaled = scaled_rows(vectors, id_col, vector_col, label_col)
    ordered = place_rows(scaled, [F.desc("square"), "vec_id", "label", "vector"], "row")
    spark = vectors.sparkSession
    placed = staged(ordered, "vectors-placed")
    total = placed.count()
    own = min(block_rows, max(1, -(-total // (2 * spark.sparkContext.defaultParallelism))))
    blocks = max(1, -(-total // own))
    rows = placed.withColumn("block", F.floor((F.col("row") - 1) / own).cast("int"))
    anchors = placed.where(is_anchor)

    def near(block, row, label, vector, _):
        return nearest_of_label(block, row, label, vector, positives)

    near_schema = (
        "row bigint, vec_id bigint, positive_row bigint, positive_id bigint, positive_score bigint"
    )
    found = _search(rows, anchors, blocks, "", near, near_schema)
    first = _ranked(found, ["row"], "positive", positives, "place")
    chosen = staged(
        first.groupBy("row", "vec_id").agg(
            F.sort_array(
                F.collect_list(F.struct("place", "positive_id", "positive_score"))
            ).alias("positives")
        ),
        "vectors-positives",
    )
    asked = anchors.join(
        chosen.select("row", F.expr("transform(positives, x -> x.positive_score)").alias("scores")),
        "row",
    )

    def below(block, row, label, vector, scores):
        for place, hits in enumerate(below_positives(block, label, vector, scores, negatives), 1):
            for hit in hits:
                yield (place, *hit)

    below_schema = (
        "row bigint, vec_id bigint, place bigint, negative_row bigint, negative_id bigint,"
        " negative_score bigint"
    )
    hits = _search(rows, asked, blocks, "scores", below, below_schema)
    ranked = _ranked(hits, ["row", "place"], "negative", negatives, "rank")
    named = chosen.select("row", F.inline("positives"))
    return ranked.join(named, ["row", "place"]).select(
        F.col("vec_id").alias("anchor_id"),
        "positive_id",
        "rank",
        "negative_id",
        "positive_score",
        "negative_score",
    )
