"""Toxicity by gradient-boosted trees over dense text features, with isotonic calibration.

Features are densities of lexicon words, lexicon stems and lexicon words behind
look-alike characters, the lexicon words near a second-person pronoun, and rates of
capitals, punctuation, digits and obfuscation. The lexicon is a short fixed list and what
the labelled texts teach: words and stems that are much more frequent in toxic texts.

Labels are learned only from rows whose crc32(doc_id as text) mod 4 is not 2, and from at
most ``sample`` of them, chosen by a hash of their id within their class: a quarter toxic and
the rest clean, or more of one where the other has fewer. Lexicon, trees and calibration each
take their own part of both classes, or all rows where a part would lack a class; calibration
weighs the classes by their true share. Labels, lang, source and doc_id are never inputs of a
score. Null and empty texts have all features 0. If all labels to learn from are of one class,
the lexicon is what they teach beside the fixed list and the score the share of lexicon words,
scaled.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laborloom.llm.shared import saved, ship

SAMPLE = 8000
THRESHOLD = 0.3
TOXIC_SHARE, LEAST_ODDS = 4, 8  # one in so many rows of the sample is toxic, where there are enough of both
#: Parts of a class's rows in the order of their hashes: calibration 8 and 9, trees 4 to 7, lexicon 0 to 3.
PARTS = (8, 4, 0, 5, 1, 6, 9, 2, 7, 3)
#: Words a learned lexicon may have, and how often and how surely they are toxic.
LEXICON_WORDS, LEAST_DOCS, LEAST_SHARE = 4000, 3, 0.6
#: Common insults, and second-person pronouns of four languages.
INSULTS = frozenset((
    "idiot idiots moron morons stupid loser losers scum trash pathetic worthless disgusting clown clowns "
    "dumb fool imbecile garbage filth vermin jerk bastard freak hate kill ugly shut").split())
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine sie ihr euch tu te toi ton ta tes "
                          "vous votre vos tú ti usted ustedes vosotros tus".split())
LOOKALIKE = str.maketrans("013457@$!|+€", "oieastasilte")
NEAR = 5
WORD = re.compile(r"[^\W\d_]+")
#: Letters with digits or signs between them, or letters spaced out by signs.
DISGUISED = re.compile(r"(?<!\w)(?=\S{0,20}[\d@$!|+€*._-][^\W_])[\w@$!|+€*.-]{3,24}(?!\w)")
#: Runs without white space that can hold one, and such a run up to its last letter.
SIGNED = re.compile(r"(?<!\S)\S*?[\d@$!|+€*._-][^\W_]\S*")
LETTERED = re.compile(r"\S*[^\W\d_]")
STEMS = (4, 5, 6)
FEATURES = 18


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def terms(text: str) -> set[str]:
    """Words of a text, and their stems marked with a star."""
    words = set(WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


@dataclass
class Lexicon:
    words: frozenset[str] = INSULTS
    stems: frozenset[str] = frozenset()
    known: dict[str, tuple[int, int]] = field(default_factory=dict)

    def kind(self, word: str) -> tuple[int, int]:
        """Whether a word is in the lexicon and whether its stem is."""
        kind = self.known.get(word)
        if kind is None:
            kind = (int(word in self.words), int(any(word[:n] in self.stems for n in STEMS if len(word) > n)))
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[word] = kind
        return kind


def disguises(text: str) -> Iterator[str]:
    """Disguised words with a letter in them or behind them in the same run without white space.

    Each run is looked at once, so the work is in proportion to the text, whatever is in it.
    """
    for run in SIGNED.finditer(text):
        lettered = LETTERED.match(text, run.start(), run.end())
        if lettered is None:
            continue
        for found in DISGUISED.finditer(text, run.start(), run.end()):
            if found.start() >= lettered.end():
                break
            yield found[0]


def near_any(places: list[int], others: list[int], distance: int) -> int:
    """How many of ``places`` have one of the sorted ``others`` within ``distance``."""
    behind = (bisect_left(others, i - distance) for i in places)
    return sum(k < len(others) and others[k] <= i + distance for i, k in zip(places, behind, strict=True))


def features(text: str, lexicon: Lexicon) -> list[float]:
    if not text:
        return [0.0] * FEATURES
    raw = WORD.findall(text)
    words = [w.lower() for w in raw]
    n, chars = max(1, len(words)), len(text)
    kinds = list(map(lexicon.kind, words))
    hits = [i for i, (a, _) in enumerate(kinds) if a]
    stems = [i for i, (_, b) in enumerate(kinds) if b]
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = near_any(list({*hits, *stems}), second, NEAR) if second else 0
    disguised = behind = 0
    for found in disguises(text):
        disguised += 1
        behind += lexicon.kind(re.sub(r"[^\w]|_", "", found.lower().translate(LOOKALIKE)))[0]
    capitals = sum(map(str.isupper, text)) if not text.islower() else 0
    shouted = sum(len(w) > 2 and w.isupper() for w in raw)
    count = text.count
    marks = sum(map(count, ".,;:'\"()-"))
    signs = sum(map(count, "*#$%&@^~"))
    digits = chars - len(text.translate(NO_DIGITS))
    return [
        len(hits) / n, np.log1p(len(hits)), len(stems) / n, np.log1p(len(stems)),
        len(set(words[i] for i in hits)), near / n, np.log1p(near), len(second) / n,
        capitals / chars, shouted / n, count("!") / chars, count("?") / chars, marks / chars, signs / chars,
        disguised / n, np.log1p(behind), digits / chars, np.log1p(chars),
    ]


NO_DIGITS = str.maketrans("", "", "0123456789")


@dataclass
class Trees:
    """Boosted regression trees of equal depth on binned features, for log loss."""

    rate: float = 0.15
    rounds: int = 80
    depth: int = 3
    bins: int = 32
    least: float = 1.0
    start: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    grown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        # Cuts at quantiles of the distinct values, so that rare ones get their own bins.
        self.cuts = [np.unique(np.quantile(np.unique(x[:, j]), np.linspace(0, 1, self.bins)[1:])) for j in range(x.shape[1])]
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        binned, score = self._binned(x), np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            gradient, curvature = y - p, p * (1 - p)
            node = np.zeros(len(y), dtype=np.int64)
            inner = (1 << self.depth) - 1
            by, at = np.zeros(inner, dtype=np.int64), np.full(inner, self.bins + 1, dtype=np.int64)
            for level in range(self.depth):
                first, width = (1 << level) - 1, 1 << level
                best = np.zeros(width)
                for j in range(x.shape[1]):
                    slot = (node - first) * (self.bins + 1) + binned[:, j]
                    g, h = (np.bincount(slot, v, width * (self.bins + 1)).reshape(width, -1).cumsum(axis=1)
                            for v in (gradient, curvature))
                    whole_g, whole_h = g[:, -1:], h[:, -1:]
                    gain = (g**2 / (h + self.least) + (whole_g - g)**2 / (whole_h - h + self.least)
                            - whole_g**2 / (whole_h + self.least))
                    cut = gain.argmax(axis=1)
                    better = gain[np.arange(width), cut] > best + 1e-9
                    best = np.where(better, gain[np.arange(width), cut], best)
                    by[first:first + width][better], at[first:first + width][better] = j, cut[better]
                node = 2 * node + 1 + (binned[np.arange(len(y)), by[node]] > at[node])
            leaf = node - inner
            g, h = (np.bincount(leaf, v, inner + 1) for v in (gradient, curvature))
            value = self.rate * g / (h + self.least)
            self.grown.append((by, at, value))
            score = score + value[leaf]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        binned, total = self._binned(x), np.full(len(x), self.start)
        rows = np.arange(len(x))
        for by, at, value in self.grown:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (binned[rows, by[node]] > at[node])
            total += value[node - len(by)]
        return total


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing step fit of ``y`` on ``score`` (pool adjacent violators)."""
    # Rows of equal scores are one point, or their order would decide where a pool ends.
    values, row = np.unique(score, return_inverse=True)
    sums, weights = (np.bincount(row, v, len(values)) for v in (y * weight, weight))
    pools: list[list[float]] = []  # sum, rows, first score, last score
    for v, n, s in zip(sums.tolist(), weights.tolist(), values.tolist(), strict=True):
        pools.append([v, n, s, s])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            v2, n2, _, last = pools.pop()
            pools[-1][0] += v2
            pools[-1][1] += n2
            pools[-1][3] = last
    at = np.array([p for pool in pools for p in (pool[2], pool[3])])
    # A bit of a row of each kind more, so that no pool is certain.
    toxic, clean = (0.1 * weight[y == v].mean() for v in (1, 0))
    share = np.array([(pool[0] + toxic) / (pool[1] + toxic + clean) for pool in pools])
    return at, np.repeat(np.maximum.accumulate(share), 2)


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees | None = None
    points: tuple[np.ndarray, np.ndarray] | None = None

    def scores(self, texts: list[str]) -> np.ndarray:
        x = np.array([features(t, self.lexicon) for t in texts], dtype=np.float64).reshape(len(texts), FEATURES)
        if self.trees is None:
            return np.minimum(1.0, 20 * (x[:, 0] + x[:, 2]))
        raw = self.trees.score(x)
        # A last bit of the raw score keeps ties of the steps apart.
        return np.clip(np.interp(raw, *self.points) * 0.999 + 0.001 / (1 + np.exp(-raw)), 0.0, 1.0)


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` labelled rows outside the held-out part: part (0 to 9), toxic, weight, text."""
    order = F.xxhash64(F.lit("toxicity"), "doc_id")
    learnable = saved(labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
                      .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    there = {r.toxic: r.n for r in learnable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    of_toxic, of_clean = sample // TOXIC_SHARE, sample - sample // TOXIC_SHARE
    bounds = {1: sample - min(of_clean, there.get(0, 0)), 0: sample - min(of_toxic, there.get(1, 0))}
    classes = [learnable.where(F.col("toxic") == v).orderBy(order, "doc_id").limit(bounds[v]).withColumn(
        "weight", F.lit(max(1.0, there.get(v, 0) / max(1, bounds[v])))) for v in (0, 1)]
    chosen = classes[0].unionByName(classes[1])  # at most ``sample`` rows
    place = F.row_number().over(W.partitionBy("toxic").orderBy(order, "doc_id")) - 1
    parts = F.array(*map(F.lit, PARTS))
    chosen = saved(chosen.select("doc_id", "toxic", "weight", F.get(parts, F.pmod(place, F.lit(10))).alias("part")))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    # One text of an id that repeats; each task leaves one, too.
    single = texts.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), *(
        F.first(c).alias(c) for c in ("part", "toxic", "weight")))
    return saved(single.select("part", "toxic", "weight", "text"))


def _terms_of(rows: DataFrame) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = list(terms(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.string()), pa.array([toxic] * len(found), pa.int32())], ["term", "toxic"])

    return rows.select("toxic", "text").mapInArrow(each, "term string, toxic int")


def clean_weight(rows: DataFrame) -> float:
    """Toxic rows that a clean one counts for in the lexicon: as many as restore the true share of
    the classes, but a share rarer than 1 to LEAST_ODDS is not made so."""
    there = {r.toxic: (r.n, r.weight) for r in rows.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight")).collect()}
    if len(there) < 2:
        return 1.0
    odds = there[1][0] / there[0][0]
    return odds / max(odds * there[1][1] / there[0][1], min(odds, 1 / LEAST_ODDS))


def learned_lexicon(rows: DataFrame) -> Lexicon:
    """Terms that are surely toxic in the labelled ``rows``, at most LEXICON_WORDS, and the fixed list."""
    counts = _terms_of(rows).groupBy("term").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("docs"))
    docs = F.col("toxic") + clean_weight(rows) * (F.col("docs") - F.col("toxic"))
    sure = counts.where((F.col("toxic") >= LEAST_DOCS) & (F.col("toxic") >= LEAST_SHARE * docs))
    found = [r.term for r in sure.orderBy(F.col("toxic").desc(), "term").limit(LEXICON_WORDS).collect()]
    return Lexicon(INSULTS | {t for t in found if t[-1] != "*"}, frozenset(t[:-1] for t in found if t[-1] == "*"))


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model; the driver gets ``sample`` rows of features and the lexicon."""
    ship(docs.sparkSession)
    rows = training_rows(docs, labels, sample)
    lexicon = learned_lexicon(rows.where("part < 4"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t, lexicon) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("toxic"), batch.column("weight"), pa.array(x, pa.list_(pa.float64()))],
                ["part", "toxic", "weight", "x"])

    rated = rows.mapInArrow(each, "part int, toxic int, weight double, x array<double>")
    taken = rated.where("part >= 4").collect()
    y = np.array([r.toxic for r in taken], dtype=np.float64)
    if not 0 < y.sum() < len(y):  # of a class with texts all may be in the lexicon's part
        taken = rated.collect()
    x = np.array([r.x for r in taken], dtype=np.float64).reshape(len(taken), FEATURES)
    y = np.array([r.toxic for r in taken], dtype=np.float64)
    weight = np.array([r.weight for r in taken], dtype=np.float64)
    last = np.array([r.part >= 8 for r in taken], dtype=bool)
    order = np.lexsort((*x.T, y, last))  # rows arrive in any order
    x, y, weight, last = x[order], y[order], weight[order], last[order]
    if not 0 < y.sum() < len(y):
        return Model(lexicon)
    trained, held = (part if 0 < y[part].sum() < part.sum() else np.ones(len(y), dtype=bool) for part in (~last, last))
    trees = Trees().fit(x[trained], y[trained])
    return Model(lexicon, trees, isotonic(trees.score(x[held]), y[held], weight[held]))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, score."""
    ship(docs.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                scores = model.scores([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], [*part.schema.names, "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "score double"])
    return docs.mapInArrow(each, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, all columns as they came."""
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    kept = scored(rows, fitted(docs, labels)).where(F.col("score") < threshold)
    return kept.select("row.*")
