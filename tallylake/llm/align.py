"""Cross-tokenizer alignment by whitespace-token anchors.

Every text is tokenised as a whole by a byte-level BPE (A) and by a sentence-piece model (B).
Tokens are laid out in bytes; an end that A and B share closes a group, and a shared end before
tokens that both begin with a space is an anchor.  Anchors cut the documents of a block into
windows of token ids.  Equal windows (the same ids of A and of B) are aligned once: their links,
which are the pieces between neighbouring ends of either side, and their text.

How often two ids are linked in the corpus is summed over blocks of documents.  A block holds a
bounded number of bytes, or one long text, and gives one row for each of its distinct pairs;
the corpus' counts come back to the block by the same rows, and there score its windows and by
them its documents.  No table of pairs is collected or broadcast.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.llm.common import row_numbers, staged, text_slices

BLOCK_BYTES = 4 << 20
ENCODE_BYTES = 1 << 19
SPACE_MARK = "▁"

#: What a document may be given; ``groups`` is text, ids of A and B as ``a1,a2|b1;a3|b2,b3``.
OUTPUTS = {
    "n_a": "bigint",
    "n_b": "bigint",
    "n_groups": "bigint",
    "n_links": "bigint",
    "n_best": "bigint",
    "count_sum": "bigint",
    "groups": "string",
    "groups_sha256": "string",
}
_SCORED = ("n_best", "count_sum")


def _byte_of_char() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_level_ranks(tokenizer_json: str) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level BPE file whose merges are in the order of the ids.

    In such a file the id of a merged token is its rank, so merging by rank gives the ids that
    the file's merges give.  Another kind of file raises.
    """
    parsed = json.loads(tokenizer_json)
    model, special = parsed["model"], {t["content"] for t in parsed["added_tokens"]}
    split = parsed["pre_tokenizer"] or {}
    plain = (
        model["type"] == "BPE"
        and parsed["normalizer"] is None
        and split.get("type") == "ByteLevel"
        and split.get("use_regex")
        and not split.get("add_prefix_space")
        and not model.get("dropout")
    )
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [model["vocab"][left + right] for left, right in merges]
    if not plain or any(a >= b for a, b in zip(made, made[1:])):
        raise ValueError("not a byte-level BPE with merges in the order of their ids")
    byte = _byte_of_char()
    return {
        bytes(byte[c] for c in token): rank
        for token, rank in model["vocab"].items()
        if token not in special
    }


class Tokenizers:
    """Both tokenizers, with the bytes, the length and the text of every id."""

    def __init__(self, json_file: bytes, model_file: bytes, pattern: str):
        import sentencepiece
        import tiktoken

        self.json_file = json_file.decode()
        ranks = byte_level_ranks(self.json_file)
        self.a = tiktoken.Encoding(
            "byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_file)
        a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            a_bytes[rank] = token
        b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.bytes = (a_bytes, b_bytes)
        self.lengths = tuple(np.array([len(t) for t in side]) for side in self.bytes)
        self.spaced = tuple(
            np.array([t.startswith(b" ") for t in side], dtype=bool) for side in self.bytes
        )
        self.texts = tuple([str(i) for i in range(len(side))] for side in self.bytes)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SPACE_MARK, " ").encode()

    @functools.cached_property
    def _whole(self):
        """The tokenizer of the file itself, for texts the faster encoder's pattern gives up on."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        whole = Tokenizer.from_str(self.json_file)
        whole.encode_special_tokens = True
        return whole

    def encode_a(self, text: str) -> np.ndarray:
        try:
            return self.a.encode_to_numpy(text, disallowed_special=()).astype(np.int32)
        except ValueError:
            ids = self._whole.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype=np.int32)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B of every text; none where a side's bytes are not those of the text."""
        b_bytes = self.bytes[1].__getitem__
        none = np.zeros(0, dtype=np.int32)
        found = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            found.append((none, none))
            if text:
                spaced = " " + text
                whole = spaced.encode()
                a = self.encode_a(spaced)
                # Tokens of A are bytes of the text in their order, so their length tells.
                same_a = int(self.lengths[0][a].sum()) == len(whole)
                if same_a and b"".join(map(b_bytes, b)) == whole:
                    found[-1] = (a, np.array(b, dtype=np.int32))
        return found


@functools.lru_cache(maxsize=1)
def _tokenizers(json_file: bytes, model_file: bytes, pattern: str) -> Tokenizers:
    return Tokenizers(json_file, model_file, pattern)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD1B54A32D192ED03)
    return h ^ (h >> np.uint64(30))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(int(lengths.sum()))


def _first_windows(
    sides: tuple[np.ndarray, np.ndarray], starts: list[np.ndarray], lengths: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Windows that are the first with their ids, and for every window which of them it equals.

    Windows are brought together by a hash of their ids and then compared id by id; should two
    windows differ under one hash, another hash is taken.
    """
    for salt in range(1, 1000):
        key = lengths[0].astype(np.uint64) * np.uint64(0xA0761D6478BD642F + 2 * salt)
        for n, (ids, start, length) in enumerate(zip(sides, starts, lengths)):
            place = np.arange(len(ids), dtype=np.uint64) - np.repeat(start, length).astype(np.uint64)
            seed = np.uint64(salt * 2 + n) << np.uint64(56)
            each = _mixed(ids.astype(np.uint64) ^ (place << np.uint64(24)) ^ seed)
            key += np.add.reduceat(each, start)
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        like = first[which]
        if all(
            np.array_equal(length, length[like])
            and np.array_equal(ids, ids[_ranges(start[like], length)])
            for ids, start, length in zip(sides, starts, lengths)
        ):
            return first, which
    raise RuntimeError("no hash told the windows apart")


class Block:
    """The aligned documents of a block.

    ``n_groups``, ``windows`` and ``groups`` are lists by document: the number of its groups, its
    windows as numbers of distinct ones, and its groups as text.  ``pairs`` are the block's
    distinct linked ids with their number of links; ``links`` of a window are places in ``pairs``.
    """

    def __init__(self, tokenizers: Tokenizers, encoded: list[tuple[np.ndarray, np.ndarray]]):
        none = np.zeros(0, dtype=np.int32)
        self.sizes = [np.array([len(e[side]) for e in encoded]) for side in (0, 1)]
        ids = tuple(
            np.concatenate([e[side] for e in encoded]) if encoded else none for side in (0, 1)
        )
        self.pairs, self.n_pairs = np.zeros((0, 2), dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.link_stops, self.links = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.n_groups = np.zeros(len(encoded), dtype=np.int64)
        self.windows = [none] * len(encoded)
        self.groups = [""] * len(encoded)
        if len(ids[0]):
            self._align(tokenizers, ids)

    def _align(self, tokenizers: Tokenizers, ids: tuple[np.ndarray, np.ndarray]) -> None:
        # Both sides of a document have its bytes, so its last tokens end at one place here.
        ends = [np.cumsum(tokenizers.lengths[side][ids[side]]) for side in (0, 1)]
        marks = []
        for end in ends:
            mark = np.zeros(int(ends[0][-1]) + 1, dtype=bool)
            mark[end] = True
            marks.append(mark)
        # Token at which each group ends, on either side.
        group_end = [np.flatnonzero(marks[1 - side][ends[side]]) for side in (0, 1)]
        n_groups = len(group_end[0])
        anchor = np.ones(n_groups, dtype=bool)
        for side in (0, 1):
            anchor[:-1] &= tokenizers.spaced[side][ids[side][group_end[side][:-1] + 1]]
        # The first token of a document has a space on both sides, so its start is an anchor.
        window_group = np.flatnonzero(anchor)
        starts, lengths = [], []
        for side in (0, 1):
            stop = group_end[side][window_group] + 1
            starts.append(np.concatenate([[0], stop[:-1]]))
            lengths.append(np.diff(np.concatenate([[0], stop])))
        first, which = _first_windows(ids, starts, lengths)

        self._link(ids, marks, [s[first] for s in starts], [n[first] for n in lengths], which)
        texts = self._texts(tokenizers, ids, group_end, window_group, first, which)
        self._deal(starts, window_group, which, texts)

    def _link(self, ids, marks, starts, lengths, which) -> None:
        """Links of the distinct windows: the pieces between neighbouring ends of either side."""
        cuts = np.flatnonzero(marks[0] | marks[1])
        # The token over a piece is the number of its side's ends before the piece's end.
        ended = [marks[side][cuts] for side in (0, 1)]
        place = [np.cumsum(e) - e for e in ended]
        # Links before each token of A, and before the end.
        before = np.concatenate([[0], np.flatnonzero(ended[0]) + 1])
        link_start = before[starts[0]]
        size = before[starts[0] + lengths[0]] - link_start
        at = _ranges(link_start, size)
        key = ids[0][place[0][at]].astype(np.int64) << 32 | ids[1][place[1][at]]
        distinct, self.links = np.unique(key, return_inverse=True)
        self.link_stops = np.cumsum(size)
        self.pairs = np.stack([distinct >> 32, distinct & 0xFFFFFFFF], axis=1)
        times = np.bincount(which, minlength=len(size))
        self.n_pairs = np.bincount(
            self.links, weights=np.repeat(times, size), minlength=len(distinct)
        ).astype(np.int64)

    def _texts(self, tokenizers, ids, group_end, window_group, first, which) -> list[str]:
        """The text of every group; equal groups of the distinct windows are written once."""
        text = tokenizers.texts
        group_stop = window_group + 1
        group_start = np.concatenate([[0], group_stop[:-1]])
        n = group_stop[first] - group_start[first]
        groups = _ranges(group_start[first], n)
        own, starts, lengths = [], [], []
        for side in (0, 1):
            stop = group_end[side] + 1
            start = np.concatenate([[0], stop[:-1]])
            size = stop[groups] - start[groups]
            own.append(ids[side][_ranges(start[groups], size)])
            starts.append(np.cumsum(size) - size)
            lengths.append(size)
        distinct, like = _first_windows(tuple(own), starts, lengths)
        made = []
        for side in (0, 1):
            at, size = starts[side][distinct].tolist(), lengths[side][distinct].tolist()
            made.append(
                [",".join([text[side][i] for i in own[side][a : a + m]]) for a, m in zip(at, size)]
            )
        joined = [f"{a}|{b}" for a, b in zip(*made)]
        # Every window has the groups of the distinct one it equals.
        every = like[_ranges((np.cumsum(n) - n)[which], n[which])]
        return list(map(joined.__getitem__, every.tolist()))

    def _deal(self, starts, window_group, which, texts: list[str]) -> None:
        first_token = np.concatenate([[0], np.cumsum(self.sizes[0])])
        bounds = np.searchsorted(starts[0], first_token)
        total = np.concatenate([[0], window_group + 1])[bounds]
        self.n_groups = np.diff(total)
        which = which.astype(np.int32)
        for doc, (i, j) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
            if j > i:
                self.windows[doc] = which[i:j]
                self.groups[doc] = ";".join(texts[total[doc] : total[doc + 1]])


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    stops = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(stops), pa.array(flat.astype(np.int32)))


_BLOCK_FIELDS = {
    "block": "bigint",
    "windows": "array<int>",
    "pair_a": "array<int>",
    "pair_b": "array<int>",
    "pair_n": "array<bigint>",
    "link_stops": "array<int>",
    "links": "array<int>",
}


def aligned_blocks(
    documents: DataFrame,
    json_path: str,
    model_path: str,
    pattern: str,
    text_col: str,
    kept: list[str],
    outputs: tuple[str, ...],
    block_bytes: int,
) -> DataFrame:
    """Documents with their alignment, staged, and one more row for each block with its pairs."""
    files = []
    for path in (json_path, model_path):
        with open(path, "rb") as file:
            files.append(file.read())
    # Two vocabulary files of fixed size, some megabytes.
    shared = documents.sparkSession.sparkContext.broadcast(tuple(files))
    rows = documents.select(
        *[documents[c].alias(f"keep_{i}") for i, c in enumerate(kept)],
        documents[text_col].cast("string").alias("__text"),
    )
    kept_fields = [f for f in rows.schema.fields if f.name != "__text"]
    plain = [o for o in OUTPUTS if o in outputs and o not in _SCORED]
    names = [*[f.name for f in kept_fields], *plain, *_BLOCK_FIELDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _tokenizers(*shared.value, pattern)
        numbers = row_numbers()
        for batch in text_slices(batches, "__text", block_bytes):
            encoded = []
            for part in text_slices(iter([batch.select(["__text"])]), "__text", ENCODE_BYTES):
                encoded += tokenizers.encode([t or "" for t in part.column(0).to_pylist()])
            block, number, n = Block(tokenizers, encoded), next(numbers), batch.num_rows
            made = {
                "n_a": pa.array(block.sizes[0], pa.int64()),
                "n_b": pa.array(block.sizes[1], pa.int64()),
                "n_groups": pa.array(block.n_groups, pa.int64()),
                "n_links": pa.array(block.sizes[0] + block.sizes[1] - block.n_groups, pa.int64()),
            }
            if "groups" in plain:
                made["groups"] = pa.array(block.groups, pa.string())
            if "groups_sha256" in plain:
                made["groups_sha256"] = pa.array(
                    [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in block.groups],
                    pa.string(),
                )
            own = {
                "block": pa.array([number] * n, pa.int64()),
                "windows": _lists(block.windows),
            }
            columns = {f.name: batch.column(f.name) for f in kept_fields}
            columns |= {name: made[name] for name in plain} | own
            types = {name: column.type for name, column in columns.items()}
            types |= {c: pa.list_(pa.int32()) for c in ("pair_a", "pair_b", "link_stops", "links")}
            types["pair_n"] = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [columns.get(c, pa.nulls(n, types[c])) for c in names], names
            )
            facts = {
                "block": pa.array([number], pa.int64()),
                "pair_a": _lists([block.pairs[:, 0]]),
                "pair_b": _lists([block.pairs[:, 1]]),
                "pair_n": pa.array([block.n_pairs], pa.list_(pa.int64())),
                "link_stops": _lists([block.link_stops]),
                "links": _lists([block.links]),
            }
            yield pa.RecordBatch.from_arrays(
                [facts.get(c, pa.nulls(1, types[c])) for c in names], names
            )

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in kept_fields]
    fields += [f"{o} {OUTPUTS[o]}" for o in plain] + [f"{c} {t}" for c, t in _BLOCK_FIELDS.items()]
    return staged(rows.mapInArrow(run, ", ".join(fields)), "align-blocks", "zstd")


def _scored_pairs(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of every block (block, place, a, b, n), and the corpus' (a, b, count, best)."""
    own = blocks.where("pair_a is not null").select(
        "block", F.posexplode(F.arrays_zip("pair_a", "pair_b", "pair_n")).alias("place", "p")
    )
    own = own.select(
        "block",
        "place",
        F.col("p.pair_a").alias("a"),
        F.col("p.pair_b").alias("b"),
        F.col("p.pair_n").alias("n"),
    )
    counts = staged(own.groupBy("a", "b").agg(F.sum("n").alias("count")), "align-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    scored = counts.join(most, "b").select(
        "a", "b", "count", (F.col("count") == F.col("most")).alias("best")
    )
    return own, scored


def align(
    documents: DataFrame,
    json_path: str,
    model_path: str,
    pattern: str,
    text_col: str = "text",
    keep: list[str] | None = None,
    outputs: tuple[str, ...] = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every row of ``documents`` with its alignment.

    A encodes a space and the text by the byte-level BPE of ``json_path`` with ``pattern``, B the
    text by the model of ``model_path``, both without special tokens.  ``n_best`` counts a row's
    links that are as frequent in the corpus as any of their B id, ``count_sum`` adds up the
    corpus' counts of its links.

    ``keep`` names the columns passed on, all by default; a column that has the name of an
    output is replaced by it.  A text that is null or empty, or whose tokens do not join to the
    space and the text, has no tokens: zeros and an empty ``groups``.  Repeated rows are rows of
    their own and count as often as they stand.  An empty table gives no rows.  A very long text
    is a block by itself; time and memory grow with its length.
    """
    unknown = set(outputs) - set(OUTPUTS)
    if unknown:
        raise ValueError(f"unknown outputs: {sorted(unknown)}")
    kept = [c for c in (documents.columns if keep is None else keep) if c not in outputs]
    blocks = aligned_blocks(
        documents, json_path, model_path, pattern, text_col, kept, outputs, block_bytes
    )
    own, scored = _scored_pairs(blocks)
    score = F.struct("place", "count", "best")
    scores = own.join(scored, ["a", "b"]).groupBy("block").agg(F.collect_list(score).alias("scores"))
    links = blocks.where("pair_a is not null").select("block", "link_stops", "links")
    # A column of its own for the key: both sides come from the same table.
    facts = links.join(scores, "block", "left").withColumnRenamed("block", "of_block")

    kept_names = [f"keep_{i}" for i in range(len(kept))]
    plain = [o for o in OUTPUTS if o in outputs and o not in _SCORED]
    docs = blocks.where("pair_a is null").select(*kept_names, *plain, "block", "windows")
    made = [*kept_names, *outputs]

    def add_scores(docs: pa.Table, facts: pa.Table) -> pa.Table:
        sums = _window_scores(facts)
        stops = np.cumsum([0] + _sizes(docs.column("windows")))
        windows = _flat(docs.column("windows"))
        columns = {c: docs.column(c) for c in [*kept_names, *plain]}
        for name, by_window in zip(_SCORED, sums):
            total = np.concatenate([[0], np.cumsum(by_window[windows])])
            columns[name] = pa.array(total[stops[1:]] - total[stops[:-1]], pa.int64())
        return pa.table({c: columns[c] for c in made})

    types = dict(docs.dtypes) | OUTPUTS
    schema = ", ".join(f"{c} {types[c]}" for c in made)
    found = (
        docs.groupBy("block").cogroup(facts.groupBy("of_block")).applyInArrow(add_scores, schema)
    )
    return found.select(
        *[F.col(c).alias(name) for c, name in zip(kept_names, kept)], *outputs
    )


def _sizes(lists: pa.ChunkedArray) -> list[int]:
    return [n for chunk in lists.chunks for n in chunk.value_lengths().to_pylist()]


def _flat(lists: pa.ChunkedArray) -> np.ndarray:
    parts = [chunk.flatten().to_numpy(zero_copy_only=False) for chunk in lists.chunks]
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, dtype=np.int64)


def _window_scores(facts: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """For every window of the block: its links that are best, and the sum of their counts."""
    stops, links = _flat(facts.column("link_stops")), _flat(facts.column("links"))
    scores = pa.concat_arrays(facts.column("scores").chunks).flatten()
    place = scores.field("place").to_numpy(zero_copy_only=False)
    values = []
    for name in ("best", "count"):
        by_pair = np.zeros(len(place), dtype=np.int64)
        by_pair[place] = scores.field(name).to_numpy(zero_copy_only=False)
        total = np.concatenate([[0], np.cumsum(by_pair[links])])
        bounds = np.concatenate([[0], stops])
        values.append(total[bounds[1:]] - total[bounds[:-1]])
    return values[0], values[1]
