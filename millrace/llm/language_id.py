"""Language of texts and of their parts: script ranges, character n-grams and a Viterbi path over words.

Each word has a score per language, the sum of its n-grams' log probabilities; languages that hardly use the
word's script are no candidates. The best path over a text's words pays a penalty for each change of
language; runs of one language on it are the text's spans. A text's language is that of most letters.

N-gram counts are learned from a bounded sample of labelled rows, drawn per language by a hash of id and text
(rows equal in both are learned from once), so that every language that has a row is learned, at every size of the table. Prediction covers all rows and whole texts.

A null text, or one without a letter (numerals such as one half are none), is ``und`` with score 0 and no spans; so is every text where nothing
could be learned. Repeated rows get a row each. Other columns are not read, an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.ship import ship_package

SCHEMA = "doc_id bigint, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"
COUNTS = "lang string, bucket int, n bigint"
WORD = re.compile(r"[^\W\d_]+")
#: First code points of script ranges: Latin, Greek, Cyrillic, Armenian, Hebrew, Arabic, Indic, Thai,
#: other, Hangul, other, kana, Han, Hangul, other.
RANGES = np.array(
    [0, 0x370, 0x400, 0x530, 0x590, 0x600, 0x900, 0xE00, 0xE80, 0x1100, 0x1200, 0x3040, 0x3100, 0xAC00, 0xD7B0]
)
BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
#: Words a worker remembers; past that it starts anew. Only speed depends on it.
CACHED_WORDS = 400_000


@dataclass(frozen=True)
class Fit:
    """``max_rows``: labelled rows to learn from, about, shared evenly among the languages; what one has less
    goes to the others. ``min_rows``: rows of each language at least, if it has them. ``switch``: penalty of a change in nats. ``script_share``: share of a language's
    letters below which a script is not its own."""

    max_rows: int = 12_000
    min_rows: int = 200
    switch: float = 8.0
    script_share: float = 0.001


@dataclass(frozen=True)
class Model:
    """``scores``: log probability of each n-gram bucket by language; ``scripts``: allowed by language."""

    languages: list[str]
    scores: np.ndarray
    scripts: np.ndarray
    switch: float


def words_of(text: str) -> list[str]:
    """The runs of letters. A pattern's words may hold numerals such as one half, which are rare and are no letters."""
    found = WORD.findall(text)
    if all(map(str.isalpha, found)):
        return found
    return [w for word in found for w in "".join(c if c.isalpha() else " " for c in word).split()]


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the words, each with a mark at both ends, and the word of each."""
    codes = np.frombuffer("".join(f"\0{w}\0" for w in words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], dtype=np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))
    buckets, owners = [], []
    rolled = np.zeros(len(codes), dtype=np.uint64)
    for order in range(1, max(ORDERS) + 1):
        shifted = np.zeros(len(codes), dtype=np.uint64)
        shifted[: len(codes) - order + 1] = codes[order - 1 :]
        rolled = rolled * np.uint64(1_000_003) + shifted + np.uint64(order)
        if order in ORDERS:
            inside = left >= order
            mixed = rolled[inside] * np.uint64(0x9E3779B97F4A7C15)
            buckets.append((mixed >> np.uint64(48)).astype(np.int64))
            owners.append(owner[inside])
    return np.concatenate(buckets), np.concatenate(owners)


def scripts_of(words: list[str]) -> np.ndarray:
    """The script range of each word's first letter."""
    return np.searchsorted(RANGES, np.array([ord(w[0]) for w in words]), side="right") - 1


def held_out() -> Column:
    """Rows a fit may not learn from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def _quota(totals: list[int], how: Fit) -> int:
    """The most rows of a language, such that all languages together have about ``max_rows``."""
    left = how.max_rows
    for place, total in enumerate(sorted(totals)):
        share = left // (len(totals) - place)
        if total > share:
            return max(share, how.min_rows)
        left -= total
    return max([how.min_rows, *totals])


def fit(labelled: DataFrame, how: Fit = Fit()) -> Model:
    """Learns from ``labelled`` (``doc_id``, ``text``, ``lang``)."""
    ship_package(labelled.sparkSession)
    known = labelled.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    known = known.withColumn("hash", F.xxhash64("doc_id", "text", F.lit(3)))
    by_lang = known.groupBy("lang").agg(F.count("*").alias("total"), F.min("hash").alias("least")).collect()
    quota = _quota([r["total"] for r in by_lang], how)
    totals = labelled.sparkSession.createDataFrame(
        [(r["lang"], r["total"], r["least"]) for r in by_lang], "lang string, total bigint, least bigint"
    )
    # The least hash is always in, so a language of few different ids is not missed.
    drawn = (F.pmod("hash", "total") < quota) | (F.col("hash") == F.col("least"))
    sample = known.join(F.broadcast(totals), "lang").where(drawn)
    sample = sample.groupBy("lang", "hash").agg(F.first("text").alias("text"))

    def count(batches: Iterator) -> Iterator:
        from millrace.llm.arrow import batch_of
        from millrace.llm.language_id import BUCKETS, COUNTS, RANGES, grams, scripts_of, words_of

        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                found = words_of(text.lower())
                if not found:
                    continue
                counts = sums.setdefault(lang, np.zeros(BUCKETS + len(RANGES), dtype=np.int64))
                np.add.at(counts, grams(found)[0], 1)
                np.add.at(counts, BUCKETS + scripts_of(found), 1)
        for lang, counts in sums.items():
            yield batch_of([(lang, int(b), int(counts[b])) for b in np.flatnonzero(counts)], COUNTS)

    counted = sample.mapInArrow(count, COUNTS).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # At most the number of languages times the buckets, whatever rows the corpus holds.
    rows = counted.toPandas()
    languages = sorted(rows["lang"].unique().tolist())
    table = np.zeros((len(languages), BUCKETS + len(RANGES)))
    place = {lang: i for i, lang in enumerate(languages)}
    if len(rows):
        table[rows["lang"].map(place).to_numpy(), rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    ngrams, scripts = table[:, :BUCKETS], table[:, BUCKETS:]
    smooth = np.log((ngrams + 0.5) / (ngrams.sum(axis=1, keepdims=True) + 0.5 * BUCKETS))
    allowed = scripts >= how.script_share * np.maximum(1, scripts.sum(axis=1, keepdims=True))
    return Model(languages, (smooth / len(ORDERS)).T.astype(np.float32).copy(), allowed.T.copy(), how.switch)


class Labeller:
    """Labels the words of many texts at once; remembers words."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.place: dict[str, int] = {}
        self.rows = np.zeros((0, len(model.languages)), dtype=np.float32)

    def _learn(self, words: list[str]) -> None:
        size = len(self.model.languages)
        new = np.zeros((len(words), size), dtype=np.float32)
        buckets, owners = grams(words)
        for k in range(size):
            new[:, k] = np.bincount(owners, weights=self.model.scores[buckets, k], minlength=len(words))
        allowed = self.model.scripts[scripts_of(words)]
        allowed = allowed | ~allowed.any(axis=1, keepdims=True)
        new -= new.max(axis=1, keepdims=True)
        new = np.where(allowed, new, np.minimum(new, 0) - np.float32(100.0))
        start = len(self.place)
        self.place.update((w, start + i) for i, w in enumerate(words))
        self.rows = np.concatenate([self.rows, new])

    def label(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The language of each word of each text, by number."""
        if len(self.place) > CACHED_WORDS:
            self.place.clear()
            self.rows = self.rows[:0]
        new = {w for words in texts for w in words if w not in self.place}
        ordered = sorted(new)
        for start in range(0, len(ordered), 50_000):
            self._learn(ordered[start : start + 50_000])
        order = sorted((i for i, words in enumerate(texts) if words), key=lambda i: -len(texts[i]))
        size = self.rows.shape[1]
        # Numbers of languages; more than 128 do not go into a byte.
        number = np.min_scalar_type(size)
        found = [np.zeros(0, number) for _ in texts]
        if not order:
            return found
        lengths = np.array([len(texts[i]) for i in order])
        place = self.place
        ids = np.fromiter((place[w] for i in order for w in texts[i]), dtype=np.int64, count=int(lengths.sum()))
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        own = np.arange(size, dtype=number)
        back = np.zeros((len(ids), size), dtype=number)
        value = self.rows[ids[starts]].astype(np.float64)
        # ``alive`` texts, the longest first, have a word at step t.
        alive = np.searchsorted(-lengths, -np.arange(int(lengths[0])), side="left")
        for t in range(1, int(lengths[0])):
            n = int(alive[t])
            at = starts[:n] + t
            now = value[:n]
            best = now.argmax(axis=1)
            switched = now[np.arange(n), best][:, None] - self.model.switch
            stay = now >= switched
            back[at] = np.where(stay, own, best[:, None].astype(number))
            value[:n] = np.where(stay, now, switched) + self.rows[ids[at]]
        state = value.argmax(axis=1).astype(number)
        path = np.zeros(len(ids), dtype=number)
        for t in range(int(lengths[0]) - 1, -1, -1):
            n = int(alive[t])
            at = starts[:n] + t
            path[at] = state[:n]
            state[:n] = back[at, state[:n]]
        for i, start, length in zip(order, starts.tolist(), lengths.tolist()):
            found[i] = path[start : start + length]
        return found


def summed(words: list[str], path: np.ndarray, languages: list[str]) -> tuple[str, float, list[dict]]:
    """A text's language, its share of the letters, and its spans as ranges of words."""
    if not words:
        return "und", 0.0, []
    letters = np.bincount(path, weights=[len(w) for w in words], minlength=len(languages))
    best = int(letters.argmax())
    edges = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(words)]
    spans = [{"start": a, "end": b, "lang": languages[path[a]]} for a, b in zip(edges, edges[1:])]
    return languages[best], float(letters[best] / letters.sum()), spans


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id``, ``lang_pred``, ``score`` (the share of letters in that language) and ``spans``
    (ranges of words, counted from 0, with their language)."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast((model.languages, model.scores, model.scripts, model.switch))

    def run(batches: Iterator) -> Iterator:
        from millrace.llm.arrow import batch_of
        from millrace.llm.language_id import SCHEMA, Labeller, Model, summed, words_of

        known = Model(*shared.value)
        labeller = Labeller(known)
        for batch in batches:
            texts = [words_of(x.lower()) if x else [] for x in batch.column("text").to_pylist()]
            if not known.languages:
                texts = [[] for _ in texts]
            paths = labeller.label(texts)
            ids = batch.column("doc_id").to_pylist()
            rows = [(i, *summed(w, p, known.languages)) for i, w, p in zip(ids, texts, paths)]
            yield batch_of(rows, SCHEMA)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, SCHEMA)
