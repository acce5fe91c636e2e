"""Elements of a JSON array found in one reading of its text, cut at every comma.

A task sees the pieces of an input split in their order, but neither whether the split
starts inside a string nor how deeply nested its start is.  Both starts of the first kind
are followed; one soon meets text that cannot stand outside a string and is dropped.  Depth
counts from the start of the split.  Commas at the lowest level seen so far cut the text:
in nearly all splits these are the commas between elements, and where the level is
lowered later, the pieces before were cut finer than needed, and are joined again.

Arrow batches are searched as arrays of bytes; memory is bounded by a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# One row per record, and per split and start one last row that carries the sums.
# start:  1 if the split is taken to start inside a string
# floor:  level of the comma that ends the record, or of the last cut before it
# k:      records that ended at this level before
# whole:  the record runs from one comma of this level to the next
# size:   bytes of the text, so that counting them leaves the text unread
# From here on in last rows only.
# odd, step, low, n_low:  quotes modulo 2; change of depth; lowest depth after a bracket, and
#         how often it was reached
# after:  level after the last piece, NULL inside a string
TRACE = (
    "file string, block bigint, start int, seq bigint, floor bigint, k bigint, whole boolean,"
    " size bigint, text binary, odd int, step bigint, low bigint, n_low bigint, after bigint, bad boolean,"
    " bytes bigint, pieces bigint, opens_array boolean, file_size bigint"
)
_TYPES = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(),
          "boolean": pa.bool_(), "binary": pa.large_binary()}
_FIELDS = [pair.split() for pair in TRACE.split(",")]
_SCHEMA = pa.schema([(name, _TYPES[kind]) for name, kind in _FIELDS])

QUOTE, BACKSLASH = ord('"'), ord("\\")
_STEP = np.zeros(256, np.int8)
_STEP[[ord("["), ord("{")]] = 1
_STEP[[ord("]"), ord("}")]] = -1
# All that can stand outside a string, names of numbers such as Infinity included.
_OUTSIDE = np.zeros(256, bool)
_OUTSIDE[list(b' \t\r\n"[]{}:+-.0123456789truefalsenullNaNInfinityINFeE')] = True

_HIGH = np.int64(1) << 60
# Unfinished text beyond this is given out as a record of its own.
_HELD_BYTES = 1 << 20
_NOTHING = pa.array([], pa.large_binary())


class _Marks:
    """Quotes and brackets of some pieces, as if outside a string at first."""

    def __init__(self, pieces: pa.Array):
        offsets = np.frombuffer(pieces.buffers()[1], np.int64)
        offsets = offsets[pieces.offset : pieces.offset + len(pieces) + 1]
        raw = pieces.buffers()[2]
        data = np.frombuffer(raw if raw is not None else b"", np.uint8)[offsets[0] : offsets[-1]]
        quotes = _unescaped(data)
        flips = np.zeros(len(data), np.uint8)
        flips[quotes] = 1
        inside = np.cumsum(flips, dtype=np.uint8) & 1
        steps = _STEP[data]
        self.size = len(data)
        self.odd = len(quotes) & 1
        self.strange = inside[~_OUTSIDE[data]]
        self.brackets = np.flatnonzero(steps)
        self.steps = steps[self.brackets].astype(np.int64)
        self.inside = inside[self.brackets]
        self.ends = offsets[1:] - offsets[0]
        self.inside_after = np.searchsorted(quotes, self.ends) & 1


def _unescaped(data: np.ndarray) -> np.ndarray:
    """Places of quotes not preceded by an odd number of backslashes."""
    quotes = np.flatnonzero(data == QUOTE)
    slashes = np.flatnonzero(data == BACKSLASH)
    if not len(slashes) or not len(quotes):
        return quotes
    begins = np.diff(slashes, prepend=-2) > 1
    length = slashes - np.maximum.accumulate(np.where(begins, slashes, 0)) + 1
    before = np.minimum(np.searchsorted(slashes, quotes - 1), len(slashes) - 1)
    escaped = (slashes[before] == quotes - 1) & (length[before] % 2 == 1)
    return quotes[~escaped]


class _Guess:
    """A split as it reads from one of the two starts."""

    def __init__(self, start: int):
        self.start = start
        self.depth = self.k = self.seq = self.n_low = 0
        self.floor = self.low = _HIGH
        self.bad = self.fresh = False
        self.held = _NOTHING

    def read(self, marks: _Marks, odd: int) -> tuple[np.ndarray, np.ndarray]:
        """Take in the marks; returns which pieces end outside a string, and their levels."""
        state = odd ^ self.start
        self.bad = self.bad or bool((marks.strange == state).any())
        out = marks.inside == state
        depths = self.depth + np.cumsum(marks.steps[out])
        if len(depths):
            low = depths.min()
            reached = int((depths == low).sum())
            self.n_low = reached + (self.n_low if low == self.low else 0) if low <= self.low else self.n_low
            self.low = min(low, self.low)
        known = np.concatenate([[self.depth], depths])
        levels = known[np.searchsorted(marks.brackets[out], marks.ends)]
        self.depth = int(known[-1])
        return marks.inside_after == state, levels

    def cut(self, pieces: pa.Array, outside: np.ndarray, levels: np.ndarray) -> dict | None:
        """The records that end in these pieces; the rest is held."""
        floors = np.minimum(np.minimum.accumulate(np.where(outside, levels, _HIGH)), self.floor)
        ends = np.flatnonzero(outside & (levels == floors))
        texts = pa.concat_arrays([self.held, pieces])
        stops = ends + 1 + len(self.held)
        done = int(stops[-1]) if len(stops) else 0
        records = None
        if len(ends):
            floors = floors[ends]
            number = np.arange(len(ends))
            first = np.searchsorted(-floors, -floors)
            k = number - first + np.where(floors == self.floor, self.k, 0)
            whole = np.concatenate([[self.fresh and floors[0] == self.floor], floors[1:] == floors[:-1]])
            records = self._records(_joined(texts, np.concatenate([[0], stops])), floors, k, whole)
            self.floor, self.k, self.fresh = floors[-1], int(k[-1]) + 1, True
        rest = texts[done:]
        self.held = _joined(rest, np.array([0, len(rest)])) if len(rest) else _NOTHING
        return records

    def overflow(self) -> dict | None:
        """Held text that has grown too long, as a record without an end."""
        if not len(self.held) or len(self.held[0].as_buffer()) <= _HELD_BYTES:
            return None
        text, self.held, self.fresh = self.held, _NOTHING, False
        return self._records(text, np.array([self.floor]), np.array([self.k]), np.array([False]))

    def _records(self, text: pa.Array, floor: np.ndarray, k: np.ndarray, whole: np.ndarray) -> dict:
        seq = np.arange(self.seq, self.seq + len(text))
        self.seq += len(text)
        return {"start": [self.start] * len(text), "seq": seq, "floor": floor, "k": k,
                "whole": whole, "size": pc.binary_length(text).cast(pa.int64()), "text": text}


def _joined(texts: pa.Array, bounds: np.ndarray) -> pa.Array:
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), texts)
    return pc.binary_join(lists, pa.scalar(b",", pa.large_binary()))


class _Split:
    """One input split; the last piece is kept back, as no comma may follow it."""

    def __init__(self, key: tuple[str, int], file_size: int, first: pa.Scalar):
        self.key, self.file_size = key, file_size
        self.opens_array = first.as_py().lstrip(b" \t\r\n")[:1] == b"["
        self.odd = self.bytes = self.pieces = 0
        self.guesses = [_Guess(0), _Guess(1)]
        self.last = _NOTHING

    def take(self, pieces: pa.Array) -> Iterator[pa.RecordBatch]:
        pieces = pa.concat_arrays([self.last, pieces])
        self.last, pieces = pieces[-1:], pieces[:-1]
        if len(pieces):
            marks = self._count(pieces)
            for guess in self.guesses:
                if not guess.bad:
                    found = guess.cut(pieces, *guess.read(marks, self.odd))
                    for records in (found, guess.overflow()):
                        if records and not guess.bad:
                            yield self._batch(len(records["text"]), records)
            self.odd ^= marks.odd

    def close(self) -> Iterator[pa.RecordBatch]:
        marks = self._count(self.last)
        for guess in self.guesses:
            outside, levels = guess.read(marks, self.odd)
            text = pa.concat_arrays([guess.held, self.last])
            text = _joined(text, np.array([0, len(text)]))
            last = guess._records(text, np.array([guess.floor]), np.array([guess.k]), np.array([False]))
            last |= {
                "odd": [self.odd ^ marks.odd],
                "step": [guess.depth],
                "low": [None if guess.low == _HIGH else int(guess.low)],
                "n_low": [guess.n_low],
                "after": [int(levels[0]) if outside[0] else None],
                "bad": [guess.bad],
                "bytes": [self.bytes],
                "pieces": [self.pieces],
                "opens_array": [self.opens_array],
                "file_size": [self.file_size],
            }
            yield self._batch(1, last)

    def _count(self, pieces: pa.Array) -> _Marks:
        marks = _Marks(pieces)
        self.bytes += marks.size
        self.pieces += len(pieces)
        return marks

    def _batch(self, n: int, columns: dict) -> pa.RecordBatch:
        columns = columns | {"file": [self.key[0]] * n, "block": [self.key[1]] * n}
        arrays = [
            pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
            for f in _SCHEMA
        ]
        # Spark expects values of the plain binary kind.
        arrays = [a.cast(pa.binary()) if pa.types.is_large_binary(a.type) else a for a in arrays]
        return pa.RecordBatch.from_arrays(arrays, names=_SCHEMA.names)


def trace_elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, file, file_size, block) in the order of the scan, to rows of ``TRACE``."""
    split = None
    for batch in batches:
        if not batch.num_rows:
            continue
        value = batch.column("value").cast(pa.large_binary())
        files, blocks = batch.column("file"), batch.column("block")
        new = pc.or_(
            pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1])
        )
        starts = [0, *(np.flatnonzero(np.asarray(new)) + 1).tolist(), batch.num_rows]
        for i, j in zip(starts, starts[1:]):
            key = (files[i].as_py(), blocks[i].as_py())
            if split is None or split.key != key:
                if split is not None:
                    yield from split.close()
                split = _Split(key, batch.column("file_size")[i].as_py(), value[i])
            yield from split.take(value[i:j])
    if split is not None:
        yield from split.close()
