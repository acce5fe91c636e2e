"""Benchmark decontamination by winnowing.

Of every window of consecutive k-gram hashes the smallest is kept as a fingerprint, the
rightmost of equal ones.  A span of ``k + window - 1`` words that a document shares with an item
fills such a window on both sides, so both keep the same fingerprint: no shared span of that
length is missed.  A document's hit is extended to both sides into every span of that length
around it, and these are joined with the items' by their words; joined spans mark their words.

The threshold is ``span_words``; an item with fewer words is matched whole, with a window of
its own length.  Documents give out only fingerprints that a Bloom filter of the items' may
hold.  The filter has a fixed size, whatever the number of items.

A gram that many items have meets only spans with the same words, not every place it has in the
items; and documents with the same spans share one list of items, so a passage of very many items
is listed once for all of them.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.llm.common import row_numbers, staged, text_slices

SPAN_WORDS = 10
GRAM_WORDS = 5
SLICE_BYTES = 4 << 20

#: Bits of the filter: one megabyte.
FILTER_BITS = 1 << 23
BITMAP_BITS = 32_768

_HIT = "struct<span:int,start:int,words:string>"


@functools.cache
def _byte_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    inside = np.zeros(256, dtype=bool)
    inside[0x30:0x3A] = inside[0x61:0x7B] = inside[0x80:] = True
    values = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
    return lower, inside, values


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Words:
    """The words of a slice of texts: places in the lower-cased bytes, row and hash of each."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
            texts.offset : texts.offset + len(texts) + 1
        ]
        size = int(offsets[-1] - offsets[0])
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if size else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        lower, inside, values = _byte_tables()
        self.text = lower[raw]
        word = inside[self.text]
        edge = np.zeros(size + 1, dtype=bool)
        edge[offsets] = True
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | edge[1:-1]
        last[:-1] &= ~word[1:] | edge[1:-1]
        self.start = np.flatnonzero(first)
        self.stop = np.flatnonzero(last) + 1
        # Words of row i are first_word[i] to first_word[i + 1].
        self.first_word = np.searchsorted(self.start, offsets)
        self.row_stop = np.repeat(self.first_word[1:], np.diff(self.first_word))
        if not len(self.start):
            self.hash = np.zeros(0, dtype=np.uint64)
            return
        lengths = self.stop - self.start
        at = np.flatnonzero(word)
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        place = np.arange(len(at)) - np.repeat(begin, lengths)
        powers = np.full(int(lengths.max()), 0x9E3779B97F4A7C15, dtype=np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        self.hash = _mix(np.add.reduceat(values[self.text[at]] * powers[place], begin))

    def fingerprints(self, span: int, gram_words: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Words at which the kept grams begin, their hashes, and the words of a gram."""
        k = min(gram_words, span)
        window = span - k + 1
        count = len(self.hash) - span + 1
        none = np.zeros(0, dtype=np.int64)
        if count <= 0:
            return none, none.astype(np.uint64), k
        grams = np.zeros(count + window - 1, dtype=np.uint64)
        for i in range(k):
            grams = grams * np.uint64(0xD6E8FEB86659FD93) + self.hash[i : i + len(grams)]
        grams = _mix(grams)
        least, at = grams[:count].copy(), np.arange(count)
        for i in range(1, window):
            other = grams[i : i + count]
            better = other <= least
            least[better] = other[better]
            at[better] = np.flatnonzero(better) + i
        inside = np.arange(count) + span <= self.row_stop[:count]
        at = np.unique(at[inside])
        return at, grams[at], k

    def strings(self, start: int, stop: int) -> list[str]:
        return [
            self.text[a:b].tobytes().decode()
            for a, b in zip(self.start[start:stop].tolist(), self.stop[start:stop].tolist())
        ]


def _bit(fp: np.ndarray) -> np.ndarray:
    return fp & np.uint64(FILTER_BITS - 1)


def _rows(
    words: Words, spans: list[tuple[int, np.ndarray | None]], gram_words: int, bloom: np.ndarray | None
) -> Iterator[tuple[int, dict]]:
    """(row, hit) for every span around a kept fingerprint; with a filter, of those it may hold."""
    for span, allowed in spans:
        at, fps, k = words.fingerprints(span, gram_words)
        if bloom is not None:
            at = at[_held(bloom, fps)]
        # A span that holds the gram begins at most span - k words before it.
        starts = np.unique((at[:, None] - np.arange(span - k + 1)).ravel())
        starts = starts[starts >= 0]
        rows = np.searchsorted(words.first_word, starts, side="right") - 1
        inside = starts + span <= words.first_word[rows + 1]
        if allowed is not None:
            inside &= allowed[rows]
        for row, start in zip(rows[inside].tolist(), starts[inside].tolist()):
            yield row, {
                "span": span,
                "start": start - int(words.first_word[row]),
                "words": " ".join(words.strings(start, start + span)),
            }


def _held(bloom: np.ndarray, fps: np.ndarray) -> np.ndarray:
    bit = _bit(fps)
    return (bloom[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _hit_type() -> pa.DataType:
    return pa.struct([("span", pa.int32()), ("start", pa.int32()), ("words", pa.string())])


def item_spans(
    items: DataFrame, id_col: str, text_col: str, span_words: int, gram_words: int
) -> DataFrame:
    """Rows (item_id, span, words, fps); a short item has its own span.

    ``fps`` are fingerprints; every one of an item stands in one of its rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", SLICE_BYTES):
            words = Words(batch.column("text"))
            counts = np.diff(words.first_word)
            spans = [
                (span, (counts == span) if span < span_words else (counts >= span))
                for span in range(1, span_words + 1)
            ]
            spans = [s for s in spans if s[1].any()]
            found = list(_rows(words, spans, gram_words, None))
            kept: list[list[int]] = [[] for _ in found]
            place = {(row, hit["span"]): n for n, (row, hit) in reversed(list(enumerate(found)))}
            for span, allowed in spans:
                at, fps, _ = words.fingerprints(span, gram_words)
                rows = np.searchsorted(words.first_word, at, side="right") - 1
                for row, fp in zip(rows.tolist(), fps.view(np.int64).tolist()):
                    if allowed[row]:
                        kept[place[row, span]].append(fp)
            ids = batch.column("item_id").take(pa.array([r for r, _ in found], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([h for _, h in found], _hit_type()),
                    pa.array(kept, pa.list_(pa.int64())),
                ],
                ["item_id", "hit", "fps"],
            )

    rows = items.select(
        F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text")
    )
    found = rows.mapInArrow(run, f"item_id string, hit {_HIT}, fps array<bigint>")
    return staged(found.select("item_id", "hit.span", "hit.words", "fps"), "winnow-items")


def _filter(fps: DataFrame) -> np.ndarray:
    """The Bloom filter as bytes: at most FILTER_BITS / 32768 bitmaps come to the driver."""
    bit = fps.select(F.explode("fps").alias("fp")).select(F.col("fp").bitwiseAND(FILTER_BITS - 1).alias("bit"))
    parts = (
        bit.groupBy(F.floor(F.col("bit") / BITMAP_BITS).cast("int").alias("part"))
        .agg(F.bitmap_construct_agg((F.col("bit") % BITMAP_BITS)).alias("bits"))
        .collect()
    )
    bloom = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    size = BITMAP_BITS // 8
    for part, bits in parts:
        bloom[part * size : (part + 1) * size] = np.frombuffer(bytes(bits), dtype=np.uint8)
    return bloom


def document_hits(
    documents: DataFrame,
    id_col: str,
    text_col: str,
    spans: list[int],
    bloom: np.ndarray,
    gram_words: int,
) -> DataFrame:
    """Rows (row_id, doc_id, text_key, n_words, hits), one per row of ``documents``."""
    shared = documents.sparkSession.sparkContext.broadcast(bloom)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = row_numbers()
        for batch in text_slices(batches, "text", SLICE_BYTES):
            words = Words(batch.column("text"))
            hits: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for row, hit in _rows(words, [(s, None) for s in spans], gram_words, shared.value):
                hits[row].append(hit)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([next(numbers) for _ in hits], pa.int64()),
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(np.diff(words.first_word), pa.int64()),
                    pa.array(hits, pa.list_(_hit_type())),
                ],
                ["row_id", "doc_id", "text_key", "n_words", "hits"],
            )

    rows = documents.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.xxhash64(text_col).alias("text_key"),
        F.col(text_col).cast("string").alias("text"),
    )
    schema = f"row_id bigint, doc_id bigint, text_key bigint, n_words bigint, hits array<{_HIT}>"
    return staged(rows.mapInArrow(run, schema), "winnow-documents")


def shared_spans(
    documents: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    span_words: int = SPAN_WORDS,
    gram_words: int = GRAM_WORDS,
) -> DataFrame:
    """One row per row of ``documents``: doc_id, text_key, n_words, spans, items.

    ``spans`` is a sorted array of (start, stop) word ranges that an item shares, disjoint and
    in the document's order; ``items`` the sorted ids, as strings, of the items with a span of
    ``span_words`` words, or all their words if they have fewer, in the document.  Null and
    empty texts have no words and share nothing; items without words match nothing; an item
    without id marks words but is not listed.  Rows that repeat an id are rows of their own;
    other columns are ignored; with an empty table there is nothing to share.  A very long text
    takes time in proportion to its length, and gives one line for each of its hits.
    """
    own = item_spans(items, item_id_col, item_text_col, span_words, gram_words)
    spans = sorted(r.span for r in own.select("span").distinct().collect())
    docs = document_hits(documents, id_col, text_col, spans, _filter(own), gram_words)

    passages = staged(
        own.select("span", "words").distinct().withColumn("passage", F.monotonically_increasing_id()),
        "winnow-passages",
    )
    hits = docs.where(F.size("hits") > 0).select("row_id", F.explode("hits").alias("h"))
    met = hits.select("row_id", "h.*").join(passages, ["span", "words"])
    # A document's spans are no more than its words.
    marked = staged(
        met.groupBy("row_id").agg(
            F.sort_array(
                F.collect_set(F.struct("start", (F.col("start") + F.col("span")).alias("stop")))
            ).alias("s"),
            F.sort_array(F.collect_set("passage")).alias("passages"),
        ),
        "winnow-marked",
    )
    # Ranges are taken in order; one that begins inside the last of the union extends it.
    union = F.aggregate(
        "s",
        F.expr("cast(array() as array<struct<start:int,stop:int>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (x["start"] <= F.element_at(done, -1)["stop"]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["stop"], x["stop"]).alias("stop"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    # Documents with the same passages have one list of items.
    members = own.join(passages, ["span", "words"]).select("passage", "item_id").distinct()
    listed = (
        marked.select("passages")
        .distinct()
        .select("passages", F.explode("passages").alias("passage"))
        .join(members, "passage")
        .groupBy("passages")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    marked = marked.select("row_id", "passages", union.alias("spans")).join(
        listed, "passages", "left"
    )
    none = F.expr("cast(array() as array<struct<start:int,stop:int>>)")
    return (
        docs.select("row_id", "doc_id", "text_key", "n_words")
        .join(marked, "row_id", "left")
        .select(
            "doc_id",
            "text_key",
            "n_words",
            F.coalesce("spans", none).alias("spans"),
            F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        )
    )


def decontaminate(
    documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``documents`` that share no span with an item."""
    found = shared_spans(documents, items, id_col, text_col).where(F.size("spans") > 0)
    hit = found.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text")).distinct()
    keyed = documents.withColumn("__key", F.xxhash64(text_col))
    same = keyed[id_col].cast("bigint").eqNullSafe(F.col("__id")) & (
        F.col("__key") == F.col("__text")
    )
    return keyed.join(hit, same, "left_anti").select(*documents.columns)
