"""Byte-level BPE by replaying the merges over many words at once.

A piece of text that the splitting pattern matches is encoded by itself, so it is enough to
encode every distinct piece once.  The pieces of a slice of documents that were not met before
are laid out in one array of symbols.  An inverted index holds, for every rank, the
positions of the token pairs that merge to it; ranks are taken in order, all positions of a rank
merge together, and only the pairs with the touched neighbours enter the index anew.

No merge crosses a piece, so the corpus may be replayed slice by slice with the same ids; that
bounds the memory of a task, needs no shuffle, and a lost task is simply run again.  A piece that
stands in many slices is encoded in each task anew, unless the task remembers it.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.llm.common import text_slices

# What a worker holds: it lives on between tasks, beside the executor's own memory.
SLICE_BYTES = 4 << 20
REMEMBERED = 250_000
NO_RANK = np.int32(2**31 - 1)

OUTPUTS = {
    "n_tokens": "bigint",
    "token_ids": "array<int>",
    "decoded": "binary",
    "ids_sha256": "string",
    "decoded_sha256": "string",
}


def read_ranks(path: str) -> bytes:
    """The rank file, read by the driver; it is of fixed size, about a megabyte."""
    with open(path, "rb") as file:
        return file.read()


class Vocabulary:
    """The tokens of a rank file and the pairs of tokens that merge."""

    def __init__(self, rank_file: bytes):
        ranks = {
            base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in rank_file.splitlines() if line)
        }
        self.ranks = ranks
        self.bytes_rank = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.base = max(ranks.values()) + 1
        self.tokens = [b""] * self.base
        for token, rank in ranks.items():
            self.tokens[rank] = token
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = rank
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int32)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank each pair merges to; NO_RANK where it does not, or a side is missing."""
        key = left.astype(np.int64) * self.base + right
        key[(left < 0) | (right < 0)] = -1
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_RANK)

    def encode_word(self, word: bytes) -> list[int]:
        """One word, pair by pair: the lowest rank first, the leftmost of equal ones.

        A heap holds the pairs, so a word of n bytes takes n log n steps.
        """
        parts = [word[i : i + 1] for i in range(len(word))]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[int, int, bytes]] = []

        def enter(at: int) -> None:
            if at >= 0 and after[at] < len(parts):
                pair = parts[at] + parts[after[at]]
                if pair in self.ranks:
                    heapq.heappush(heap, (self.ranks[pair], at, pair))

        for at in range(len(parts)):
            enter(at)
        while heap:
            _, at, pair = heapq.heappop(heap)
            right = after[at]
            # A pair that a merge has changed since is no longer there.
            if not parts[at] or right >= len(parts) or parts[at] + parts[right] != pair:
                continue
            parts[at], parts[right] = pair, b""
            after[at] = after[right]
            if after[right] < len(parts):
                before[after[right]] = at
            enter(at)
            enter(before[at])
        return [self.ranks[p] for p in parts if p]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of every word as little-endian 32-bit integers."""
        done = [self.ranks.get(w) for w in words]
        rest = [w for w, rank in zip(words, done) if rank is None]
        replayed = iter(self._replay(rest))
        return [
            next(replayed) if rank is None else rank.to_bytes(4, "little") for rank in done
        ]

    def _replay(self, words: list[bytes]) -> list[bytes]:
        if not words:
            return []
        lengths = np.array([len(w) for w in words])
        # A gap of one symbol keeps the words apart.
        ends = np.cumsum(lengths + 1)
        symbol = np.full(ends[-1] + 1, -1, dtype=np.int32)
        text = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", dtype=np.uint8)
        inside = np.ones(len(symbol), dtype=bool)
        inside[0] = False
        inside[ends] = False
        symbol[inside] = self.bytes_rank[text[inside]]
        here = np.arange(len(symbol), dtype=np.int32)
        after, before = here + 1, here - 1
        rank = np.full(len(symbol), NO_RANK, dtype=np.int32)
        rank[:-1] = self.merged(symbol[:-1], symbol[1:])

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(positions: np.ndarray) -> None:
            ranks = rank[positions]
            positions = positions[ranks != NO_RANK]
            ranks = ranks[ranks != NO_RANK]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            starts = [0, *cuts.tolist(), len(ranks)]
            for a, b in zip(starts, starts[1:]):
                r = int(ranks[a])
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(positions[a:b])

        enter(here[rank != NO_RANK])
        odd = np.zeros(0, dtype=np.int64)
        while heap:
            r = heapq.heappop(heap)
            held = index.pop(r)
            at = np.concatenate(held)
            at = np.unique(at[rank[at] == r])
            if not len(at):
                continue
            if len(at) > 1:
                # Of pairs that overlap, as in "aaa", every other one merges, from the left.
                run = np.ones(len(at), dtype=bool)
                run[1:] = after[at[:-1]] != at[1:]
                if not run.all():
                    order = np.arange(len(at))
                    start = np.maximum.accumulate(np.where(run, order, 0))
                    at = at[(order - start) % 2 == 0]
            right = after[at]
            beyond = after[right]
            symbol[at] = r
            symbol[right] = -1
            rank[right] = NO_RANK
            after[at] = beyond
            before[beyond] = at
            left = before[at]
            rank[at] = self.merged(symbol[at], symbol[beyond])
            rank[left] = self.merged(symbol[left], symbol[at])
            touched = np.concatenate([at, left])
            lower = touched[rank[touched] < r]
            if len(lower) and len(at) > 1:
                # A lower rank arose while others of this rank merged: such words are
                # encoded one by one below.
                odd = np.union1d(odd, np.searchsorted(ends, lower, side="left"))
            enter(touched)

        alive = symbol >= 0
        ids = symbol[alive].astype("<u4").tobytes()
        stop = (np.cumsum(alive)[ends] * 4).tolist()
        out = [ids[a:b] for a, b in zip([0, *stop], stop)]
        for word in odd.tolist():
            out[word] = np.array(self.encode_word(words[word]), dtype="<u4").tobytes()
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@functools.lru_cache(maxsize=1)
def _vocabulary(rank_file: bytes, pattern: str) -> tuple[Vocabulary, dict[str, bytes]]:
    """The vocabulary and the pieces met so far; a worker process serves many tasks."""
    return Vocabulary(rank_file), {}


@functools.cache
def _splitter(pattern: str):
    return regex.compile(pattern)


def encode_texts(
    texts: Iterable[str], vocabulary: Vocabulary, pattern: str, known: dict[str, bytes]
) -> list[bytes]:
    """Ids of every text; ``known`` remembers pieces, up to a bound, from slice to slice."""
    split = _splitter(pattern).findall
    pieces = [split(t) for t in texts]
    words = list(set().union(*pieces).difference(known))
    encoded = dict(zip(words, vocabulary.encode_words([w.encode() for w in words])))
    if len(known) + len(words) <= REMEMBERED:
        known.update(encoded)
        encoded = {}
    if not encoded:
        return [b"".join(map(known.__getitem__, own)) for own in pieces]
    return [b"".join([known.get(p) or encoded[p] for p in own]) for own in pieces]


def tokenize(
    documents: DataFrame,
    rank_path: str,
    pattern: str,
    text_col: str = "text",
    keep: list[str] | None = None,
    outputs: tuple[str, ...] = ("n_tokens", "token_ids", "decoded"),
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Every row of ``documents`` with its token ids and what they decode to.

    ``keep`` names the columns that are passed on, all by default; a column of ``documents``
    that has the name of an output is replaced by it.  ``outputs`` are taken from OUTPUTS.
    A null text is an empty one: no tokens.  Repeated rows are rows of their own; an empty table
    gives no rows.  A very long text is a slice by itself; time and memory grow with its length.
    """
    unknown = set(outputs) - set(OUTPUTS)
    if unknown:
        raise ValueError(f"unknown outputs: {sorted(unknown)}")
    spark = documents.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(rank_path))
    kept = [c for c in (documents.columns if keep is None else keep) if c not in outputs]
    rows = documents.select(
        *[documents[c] for c in kept], F.col(text_col).cast("string").alias("__text")
    )

    def row_outputs(vocabulary: Vocabulary, encoded: list[bytes]) -> list[pa.Array]:
        decoded = None
        if "decoded" in outputs or "decoded_sha256" in outputs:
            decoded = [vocabulary.decode(ids) for ids in encoded]
        made = []
        for name in outputs:
            if name == "n_tokens":
                made.append(pa.array([len(ids) // 4 for ids in encoded], pa.int64()))
            elif name == "token_ids":
                stops = np.cumsum([0] + [len(ids) // 4 for ids in encoded]).astype(np.int32)
                flat = np.frombuffer(b"".join(encoded), dtype="<u4").astype(np.int32)
                made.append(pa.ListArray.from_arrays(pa.array(stops), pa.array(flat)))
            elif name == "decoded":
                made.append(pa.array(decoded, pa.binary()))
            else:
                data = encoded if name == "ids_sha256" else decoded
                made.append(pa.array([hashlib.sha256(x).hexdigest() for x in data], pa.string()))
        return made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = _vocabulary(ranks.value, pattern)
        for batch in text_slices(batches, "__text", slice_bytes):
            texts = [t or "" for t in batch.column("__text").to_pylist()]
            encoded = encode_texts(texts, vocabulary, pattern, known)
            arrays = [batch.column(c) for c in kept] + row_outputs(vocabulary, encoded)
            yield pa.RecordBatch.from_arrays(arrays, [*kept, *outputs])

    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text"]
        + [f"{name} {OUTPUTS[name]}" for name in outputs]
    )
    return rows.mapInArrow(run, schema)
