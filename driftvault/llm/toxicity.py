"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier of hashed character n-grams of words is trained in numpy from texts confirmed as toxic and texts taken as unlabelled.
Its risk is the positives' loss times the class prior, plus the unlabelled texts' loss as negatives less the part
that the positives among them make up; that difference may not fall below zero.
"""

from __future__ import annotations

import re
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftvault.llm.common import stage

#: Bounds of the training sample: the rows with the smallest hashes of doc_id are taken.
MAX_POSITIVE, MAX_UNLABELLED = 6_000, 14_000
#: n-grams of words with their start and end marked; told apart by so many buckets.
GRAMS, BUCKETS = range(3, 8), 1 << 22
#: An n-gram counts if it is this many standard deviations more or less frequent in the positives, in so many texts;
#: of those the most telling ones are taken.
MIN_Z, MIN_TEXTS, MAX_FEATURES = 5.0, 5, 4096
STEPS, RATE, RIDGE = 400, 0.1, 1e-4
THRESHOLD = 0.7
CACHED_WORDS = 300_000
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Weights by n-gram bucket; at most MAX_FEATURES of them."""

    weights: dict[int, float]
    bias: float


def buckets(word: str) -> set[int]:
    """The buckets of a word's n-grams."""
    marked = f"^{word}$".encode("utf-32-le", "surrogatepass")
    return {zlib.crc32(marked[4 * i : 4 * (i + n)]) % BUCKETS for n in GRAMS for i in range(len(marked) // 4 - n + 1)}


class Features:
    """The chosen buckets (all, where none are given) of texts; words that come again are remembered."""

    def __init__(self, chosen=None):
        self.chosen, self._known = chosen, {}

    def of(self, text: str | None) -> set[int]:
        out: set[int] = set()
        for word in set(_WORD.findall((text or "").lower())):
            found = self._known.get(word)
            if found is None:
                if len(self._known) > CACHED_WORDS:
                    self._known.clear()
                found = buckets(word)
                if self.chosen is not None:
                    found = found & self.chosen
                    self._known[word] = found
            if found:
                out |= found
        return out


#: Texts that are worked on at once in the driver.
CHUNK = 1000


class Texts:
    """Texts by the columns of their features: two bytes for each, whatever the rest takes is held for CHUNK texts."""

    def __init__(self, rows: list[np.ndarray]):
        self.chunks = []
        for at in range(0, len(rows), CHUNK):
            part = rows[at : at + CHUNK]
            self.chunks.append((np.concatenate([np.asarray(r, np.uint16) for r in part]), np.array([len(r) for r in part])))
        self.n = len(rows)

    def odds(self, w: np.ndarray, b: float) -> np.ndarray:
        return b + np.concatenate([np.bincount(np.repeat(np.arange(len(n)), n), w[col], minlength=len(n)) for col, n in self.chunks])

    def summed(self, per_text: np.ndarray, features: int) -> np.ndarray:
        """For each feature the sum of its texts' numbers."""
        out, at = np.zeros(features), 0
        for col, n in self.chunks:
            out += np.bincount(col, np.repeat(per_text[at : at + len(n)], n), minlength=features)
            at += len(n)
        return out


def risk(positive: Texts, unlabelled: Texts, w: np.ndarray, b: float, prior: float) -> tuple[float, float, np.ndarray]:
    """The two parts of the estimated risk, and the gradient that a step follows, for (w, b).

    With the logistic loss, the first part is what positives cost as positives, times the prior. The second is what
    unlabelled texts cost as negatives, less what the positives among them do. It cannot be below zero for the true
    distribution; where the sample's is, the fit has gone too far, and the gradient is that of its negative alone.
    """
    p, u = positive.odds(w, b), unlabelled.odds(w, b)
    as_positive = prior * np.logaddexp(0, -p).mean()
    as_negative = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
    p, u = 1 / (1 + np.exp(-p)), 1 / (1 + np.exp(-u))
    if as_negative < 0:
        per_text = (prior * p / len(p), -u / len(u))
    else:
        per_text = (prior * (p - 1) / len(p) - prior * p / len(p), u / len(u))
    grad = np.zeros(len(w) + 1)
    for texts, g in zip((positive, unlabelled), per_text):
        grad[:-1] += texts.summed(g, len(w))
        grad[-1] += g.sum()
    return as_positive, as_negative, grad


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], chosen: np.ndarray, prior: float) -> Model:
    """positive, unlabelled: where in `chosen` each text's buckets are. prior: the share of positives among the unlabelled."""
    if not positive or not unlabelled or not 0 < prior < 1:
        return Model({}, -20.0 if not prior > 0 else 20.0 if prior >= 1 else float(np.log(prior / (1 - prior))))
    sets = Texts(positive), Texts(unlabelled)
    w, b = np.zeros(len(chosen)), float(np.log(prior / (1 - prior)))
    m1, m2 = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, STEPS + 1):
        grad = risk(*sets, w, b, prior)[2]
        grad[:-1] += RIDGE * w
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
        move = RATE * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(dict(zip(chosen.tolist(), w.tolist())), b)


def _count(frames):
    """(bucket, positive, unlabelled): in how many of the partition's texts each bucket is found."""
    counts, features = np.zeros((2, BUCKETS), np.int32), Features()
    for frame in frames:
        for text, toxic, unlabelled in zip(frame["text"], frame["toxic"], frame["unlabelled"]):
            found = np.fromiter(features.of(text), np.int64)
            counts[0, found] += int(toxic)
            counts[1, found] += int(unlabelled)
    any_ = np.flatnonzero(counts.any(axis=0))
    for at in range(0, len(any_), 100_000):
        part = any_[at : at + 100_000]
        yield pd.DataFrame({"bucket": part, "positive": counts[0, part], "unlabelled": counts[1, part]})


def _choose(counts: DataFrame, positives: int, unlabelled: int) -> np.ndarray:
    df = counts.groupBy("bucket").agg(F.sum("positive").alias("p"), F.sum("unlabelled").alias("u")).filter(F.col("p") + F.col("u") >= MIN_TEXTS)
    share = (F.col("p") + F.col("u")) / F.lit(positives + unlabelled)
    spread = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) * (1 / positives + 1 / unlabelled))
    z = F.abs(F.col("p") / positives - F.col("u") / unlabelled) / spread
    top = df.select("bucket", z.alias("z")).filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "bucket").limit(MAX_FEATURES)
    return np.sort(top.toPandas()["bucket"].to_numpy("int64"))


def _featurise(chosen: np.ndarray):
    """Each text's features, as their places in `chosen`, two bytes for each."""

    def task(frames):
        features = Features(frozenset(chosen.tolist()))
        for frame in frames:
            found = [np.searchsorted(chosen, sorted(features.of(t))).astype("<u2").tobytes() for t in frame["text"]]
            yield pd.DataFrame({"toxic": frame["toxic"], "unlabelled": frame["unlabelled"], "found": found})

    return task


def train(docs: DataFrame, labels: DataFrame, usable: Column) -> Model:
    """docs (doc_id, text), labels (doc_id, toxic); usable: a condition on doc_id. The positives are texts confirmed
    as toxic; the unlabelled ones are drawn from all usable docs, whether they have a label or not. The class prior
    is the share of toxic ones among the usable labels, which are taken to be a random part of docs. Of both kinds at
    most the stated numbers are used, those whose doc_id has the smallest hashes."""
    # doc_id twice with different labels: toxic if one says so
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).filter(usable).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    every = docs.filter(F.col("doc_id").isNotNull()).filter(usable).select("doc_id").distinct()
    known = stage(known.join(every, "doc_id", "left_semi"), "toxicity-labels")  # labels of other documents say nothing of these
    total, toxic = known.agg(F.count("*"), F.coalesce(F.sum(F.when(F.col("toxic") == 1, 1)), F.lit(0))).first()
    if not total:
        return fit([], [], np.zeros(0, np.int64), 0.0)

    def first(ids: DataFrame, seed: int, most: int) -> DataFrame:
        return ids.select("doc_id", F.xxhash64(F.lit(seed), "doc_id").alias("rank")).orderBy("rank", "doc_id").limit(most)

    taken = (
        first(known.filter("toxic = 1"), 11, MAX_POSITIVE).select("doc_id", F.lit(1).alias("toxic"), F.lit(0).alias("unlabelled"))
        .unionByName(first(every, 12, MAX_UNLABELLED).select("doc_id", F.lit(0).alias("toxic"), F.lit(1).alias("unlabelled")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("unlabelled").alias("unlabelled"))
    )
    # at most MAX_POSITIVE + MAX_UNLABELLED rows are broadcast
    texts = stage(docs.select("doc_id", "text").join(F.broadcast(stage(taken, "toxicity-sample")), "doc_id").dropDuplicates(["doc_id"]), "toxicity-texts")
    positives, unlabelled = (int(n or 0) for n in texts.agg(F.sum("toxic"), F.sum("unlabelled")).first())
    chosen = np.zeros(0, np.int64)
    if positives and unlabelled:
        chosen = _choose(texts.mapInPandas(_count, "bucket long, positive int, unlabelled int"), positives, unlabelled)
    # at most MAX_POSITIVE + MAX_UNLABELLED rows of MAX_FEATURES numbers of two bytes
    rows = texts.mapInPandas(_featurise(chosen), "toxic int, unlabelled int, found binary").toPandas()
    found = rows["found"].map(lambda x: np.frombuffer(x, "<u2"))
    return fit(found[rows["toxic"] == 1].tolist(), found[rows["unlabelled"] == 1].tolist(), chosen, toxic / total)


_FEATURES: dict[str, Features] = {}


def score_column(text: Column, model: Model, spark) -> Column:
    """Column of double, 0 to 1: the estimated probability that a text is toxic."""
    shared = spark.sparkContext.broadcast(model)
    token = uuid.uuid4().hex

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        model = shared.value
        if token not in _FEATURES:
            _FEATURES.clear()
            _FEATURES[token] = Features(frozenset(model.weights))
        of = _FEATURES[token].of
        odds = np.array([model.bias + sum(map(model.weights.__getitem__, of(t))) for t in texts], np.float64)
        return pd.Series(1 / (1 + np.exp(-np.clip(odds, -500, 500))))

    return score(text)


def usable_for_training(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3 != 1


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted.

    Null and empty texts get the score of a text without known words. A null doc_id is not held out and teaches
    nothing. Repeated rows are scored each for itself and teach once. Without labels every score is near 0. An
    empty table gives an empty result; other columns are not looked at.
    """
    model = train(docs, labels, usable_for_training(F.col("doc_id")))
    rows = docs.select("doc_id", F.coalesce(~usable_for_training(F.col("doc_id")), F.lit(False)).alias("held_out"), score_column(F.col("text"), model, docs.sparkSession).alias("score"))
    return rows.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that score below the threshold, with docs' own columns.

    The classifier learns from the labels of docs' rows outside the fold that is held out; a null doc_id has no label.
    Null and empty texts have the score of no n-gram, very long ones whole. Repeated rows have one score, so all stay or
    all go; where nothing can be learnt, as of an empty table, all stay.
    """
    model = train(docs, labels, usable_for_training(F.col("doc_id")))
    return docs.filter(score_column(F.col("text"), model, docs.sparkSession) < THRESHOLD)
