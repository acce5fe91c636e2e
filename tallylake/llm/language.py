"""Language identification by a mixture of languages.

Every word of a text is written in one of its languages; a word's likelihood in a language is
that of its letter trigrams.  Expectation-maximisation finds the share of each language in each
text; of the nested sets of its most likely languages the one with the largest likelihood,
less a penalty for every further language, is kept.

The trigram model is counted over all labelled texts in Spark, each task giving one row for
each language and trigram it met; trigrams are hashed to a fixed number of features, so the
model has a fixed size for a language.  All texts of a slice go through the iterations together.
"""

from __future__ import annotations

import functools
import itertools
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.llm.common import text_slices

FEATURES = 1 << 17
#: Of more languages than this only those with most trigrams are learned: with FEATURES the
#: bound of what is broadcast, 50 MB.
MAX_LANGUAGES = 100
#: Share of the model of all languages in that of one: what a trigram unseen in a language gets.
BACKGROUND = 0.01
#: For each further language a set's log-likelihood must gain this many times log(words + 1).
PENALTY = 3.0
ROUNDS = 12
SLICE_BYTES = 8 << 20
#: Words times languages of a slice, about: the memory of a task.
SLICE_CELLS = 32 << 20
#: Languages a task counts before it gives out what it has.
HELD_LANGUAGES = 32
UNKNOWN = "und"
_TINY = 1e-290

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> Counter:
    """Lower-case runs of letters and how often each stands in the text."""
    found = Counter(_WORD.findall(text.lower())) if text else Counter()
    # The pattern also takes a few numerals that are no letters, such as a raised two.
    for word in [w for w in found if not w.isalpha()]:
        letters = "".join(filter(str.isalpha, word))
        count = found.pop(word)
        if letters:
            found[letters] += count
    return found


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of the trigrams of each word between blanks, and where each word's begin."""
    text = np.frombuffer(("  ".join(["", *words, ""])[1:-1]).encode("utf-32-le"), np.uint32)
    text = text.astype(np.uint64)
    h = text[:-2] * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) + text[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x165667B19E3779F9) + text[2:]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    feature = ((h ^ (h >> np.uint64(32))) & np.uint64(FEATURES - 1)).astype(np.int64)
    lengths = np.array([len(w) for w in words])
    # A word of n letters has n trigrams; two more stand across the blanks to the next word.
    starts = np.cumsum(lengths + 2) - (lengths + 2)
    own = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    return feature[own], np.cumsum(lengths) - lengths


def count_trigrams(words: Counter) -> np.ndarray:
    """How often each feature occurs in the counted words."""
    if not words:
        return np.zeros(FEATURES, dtype=np.int64)
    feature, _ = trigrams(list(words))
    times = np.repeat(list(words.values()), [len(w) for w in words])
    return np.bincount(feature, weights=times, minlength=FEATURES).astype(np.int64)


class Model:
    """Log-likelihoods of features by language; languages in the order of their names."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        total = counts.sum(axis=1)
        background = (total + 1) / (total.sum() + len(total))
        own = counts / np.maximum(counts.sum(axis=0), 1)
        mixed = (1 - BACKGROUND) * own + BACKGROUND * background[:, None]
        self.log = np.log(mixed).astype(np.float32)

    def word_likelihoods(self, words: list[str]) -> np.ndarray:
        feature, starts = trigrams(words)
        return np.add.reduceat(self.log[feature], starts, axis=0, dtype=np.float64)


class Mixtures:
    """The language shares of several texts, each given as counted words; none may be empty."""

    def __init__(self, model: Model, texts: list[Counter]):
        vocabulary = {w: i for i, w in enumerate(dict.fromkeys(itertools.chain(*texts)))}
        log = model.word_likelihoods(list(vocabulary))
        log -= log.max(axis=1, keepdims=True)
        word = np.fromiter(map(vocabulary.__getitem__, itertools.chain(*texts)), np.int64)
        self.count = np.fromiter(
            itertools.chain.from_iterable(t.values() for t in texts), np.float64
        )
        sizes = np.array([len(t) for t in texts])
        self.starts = np.cumsum(sizes) - sizes
        self.text = np.repeat(np.arange(len(texts)), sizes)
        self.log, self.likely = log[word], np.maximum(np.exp(log), _TINY)[word]
        self.words = np.add.reduceat(self.count, self.starts)

    def fit(self, shares: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares after the rounds of the chosen texts, and their log-likelihoods.

        A language without a share at first stays out.
        """
        chosen = np.zeros(len(self.words), dtype=bool)
        chosen[texts] = True
        rows = slice(None) if chosen.all() else chosen[self.text]
        likely, count = self.likely[rows], self.count[rows]
        own = (np.cumsum(chosen) - 1)[self.text[rows]]
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        words = self.words[texts][:, None]
        for _ in range(ROUNDS):
            joint = likely * shares[own]
            joint *= (count / np.maximum(joint.sum(axis=1), _TINY))[:, None]
            shares = np.add.reduceat(joint, starts, axis=0) / words
        total = np.maximum((likely * shares[own]).sum(axis=1), _TINY)
        return shares, np.add.reduceat(count * np.log(total), starts)

    def select(self) -> np.ndarray:
        """Shares of the languages of every text under the set with the best penalised value."""
        everyone = np.arange(len(self.words))
        n = self.likely.shape[1]
        single = np.add.reduceat(self.log * self.count[:, None], self.starts, axis=0)
        first = single.argmax(axis=1)
        best, value = np.zeros((len(first), n)), single.max(axis=1)
        best[everyone, first] = 1.0
        if n == 1:
            return best
        price = PENALTY * np.log(self.words + 1)
        shares, most = self.fit(np.full((len(first), n), 1.0 / n), everyone)
        # Sets grow by the languages with the largest shares among all; the first stays first.
        shares[everyone, first] = 2.0
        order = np.argsort(-shares, axis=1, kind="stable")
        shares[everyone, first] = 1.0
        open_ = everyone
        for size in range(2, n + 1):
            # No set is likelier than all languages together.
            open_ = open_[most[open_] - (size - 1) * price[open_] > value[open_]]
            if not len(open_):
                break
            start = np.zeros((len(open_), n))
            start[np.arange(len(open_))[:, None], order[open_, :size]] = 1.0 / size
            found, likelihood = self.fit(start, open_)
            gained = likelihood - (size - 1) * price[open_]
            better = gained > value[open_]
            best[open_[better]] = found[better]
            value[open_[better]] = gained[better]
            open_ = open_[better]
        return best


# --- in Spark -------------------------------------------------------------------------


def learn(labelled: DataFrame, text_col: str, lang_col: str, max_languages: int) -> Model | None:
    """The model of all rows with a text and a language; None if there is no such row."""
    rows = labelled.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    ).where("lang is not null and text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def given() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                feature = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(feature), pa.string()),
                        pa.array(feature, pa.int32()),
                        pa.array(counts[feature], pa.int64()),
                    ],
                    ["lang", "feature", "n"],
                )
            held.clear()

        for batch in text_slices(batches, "text", SLICE_BYTES):
            by_lang: dict[str, Counter] = {}
            for lang, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "text"))):
                by_lang.setdefault(lang, Counter()).update(words_of(text))
            for lang, words in by_lang.items():
                if lang not in held and len(held) >= HELD_LANGUAGES:
                    yield from given()
                counts = count_trigrams(words)
                held[lang] = held[lang] + counts if lang in held else counts
        yield from given()

    counted = (
        rows.mapInArrow(run, "lang string, feature int, n bigint")
        .groupBy("lang", "feature")
        .agg(F.sum("n").alias("n"))
    )
    by_lang = counted.groupBy("lang").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("feature", "n")).alias("counts")
    )
    # At most max_languages rows of at most FEATURES pairs come to the driver.
    top = by_lang.orderBy(F.desc("total"), "lang").limit(max_languages).toArrow()
    if not top.num_rows:
        return None
    languages = top.column("lang").to_pylist()
    counts = np.zeros((FEATURES, len(languages)))
    pairs = top.column("counts").combine_chunks()
    sizes = pairs.value_lengths().to_numpy(zero_copy_only=False)
    flat = pairs.flatten()
    column = np.repeat(np.arange(len(languages)), sizes)
    counts[flat.field("feature").to_numpy(), column] = flat.field("n").to_numpy()
    order = sorted(range(len(languages)), key=languages.__getitem__)
    return Model([languages[i] for i in order], counts[:, order])


@functools.lru_cache(maxsize=1)
def _model(pickled: bytes) -> Model:
    return pickle.loads(pickled)


_FOUND = "lang_pred string, score double, languages array<struct<lang:string,share:double>>"


def identify(
    documents: DataFrame,
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    keep: list[Column] | None = None,
    max_languages: int = MAX_LANGUAGES,
) -> DataFrame:
    """The ``keep`` columns (all by default) of every row with lang_pred, score and languages.

    The model is learned from the texts and languages of ``labelled``; of ``documents`` only the
    text is looked at.  ``languages`` are those of the text with their shares, the largest
    first; ``lang_pred`` is the first of them and ``score`` its share.  A text that is null or has
    no letter, or any text if nothing was learned, is ``und`` with score 0 and no languages.

    Columns named like an output are replaced.  Rows without text or language teach nothing;
    repeated rows count as often as they stand; of an empty table there are no rows.  A text is
    taken whole; time and memory grow with its distinct words and the languages.
    """
    model = learn(labelled, text_col, lang_col, max_languages)
    shared = documents.sparkSession.sparkContext.broadcast(
        None if model is None else pickle.dumps(model)
    )
    made = ["lang_pred", "score", "languages"]
    kept = [documents[c] for c in documents.columns if c not in made] if keep is None else keep
    rows = documents.select(*kept, F.col(text_col).cast("string").alias("__text"))
    fields = [f for f in rows.schema.fields if f.name != "__text"]
    n_languages = 1 if model is None else len(model.languages)
    slice_bytes = max(1 << 16, min(SLICE_BYTES, SLICE_CELLS // n_languages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None if shared.value is None else _model(shared.value)
        for batch in text_slices(batches, "__text", slice_bytes):
            found = [(UNKNOWN, 0.0, [])] * batch.num_rows
            words = [words_of(t) for t in batch.column("__text").to_pylist()]
            some = [i for i, w in enumerate(words) if w]
            if model is not None and some:
                shares = Mixtures(model, [words[i] for i in some]).select()
                order = np.argsort(-shares, axis=1, kind="stable")
                for i, own, ranked in zip(some, shares.tolist(), order.tolist()):
                    languages = [(model.languages[k], own[k]) for k in ranked if own[k] > 0]
                    lang, share = languages[0]
                    found[i] = (lang, min(1.0, share), languages)
            columns = [batch.column(f.name) for f in fields]
            pairs = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
            columns.append(pa.array([f[0] for f in found], pa.string()))
            columns.append(pa.array([f[1] for f in found], pa.float64()))
            columns.append(
                pa.array([[{"lang": a, "share": b} for a, b in f[2]] for f in found], pairs)
            )
            yield pa.RecordBatch.from_arrays(columns, [*[f.name for f in fields], *made])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [_FOUND])
    return rows.mapInArrow(run, schema)
