"""Toxicity by non-negative positive-unlabelled learning.

Positives are documents confirmed as toxic; documents without a label are the
unlabelled text (filled up with those not confirmed where they are few). A linear
model over hashed word features is fitted in numpy by minimising

    prior * E_pos[l(f)] + max(0, E_unl[l(-f)] - prior * E_pos[l(-f)])

with the logistic loss l. When the bracket of a batch turns negative, the step
raises it again instead of lowering the risk further; that is the non-negative
correction. Only features seen more often among the positives than chance
explains get a weight, and none below zero: a word can speak for toxicity, not
make up for it. The class prior is the share of toxic rows among the labelled rows
of the learning folds.

A document's score is the sum over its distinct words, so a word's score is
computed once and kept; scoring reads whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.llm.common import Cache, fold

PUNCTUATION = ".,;:!?\"'()[]{}<>*#%$&|-_/\\"


@dataclass(frozen=True)
class PuParams:
    """``most_positive`` and ``most_unlabelled`` bound the rows the model is fitted on, not those it scores."""

    folds: int = 5
    dimensions: int = 1 << 18
    most_positive: int = 5000
    most_unlabelled: int = 15_000
    epochs: int = 30
    batch: int = 1024
    rate: float = 0.03
    decay: float = 1e-5
    stems: tuple[int, ...] = (4, 5)
    errors: float = 7.0
    least: float = 1.0


@dataclass(frozen=True)
class PuModel:
    weights: np.ndarray
    bias: float
    params: PuParams


def word_features(word: str, params: PuParams) -> list[int]:
    """Hashed features of a word without its outer punctuation: the word, and its beginnings if it is longer."""
    word = word.strip(PUNCTUATION)
    if not word:
        return []
    found = [zlib.crc32(b"w" + word.encode()) % params.dimensions]
    found += [zlib.crc32(b"s" + word[:n].encode()) % params.dimensions for n in params.stems if len(word) > n]
    return found


def document_words(text: str | None) -> set[str]:
    return set(text.lower().split()) if text else set()


def _features_of(params: PuParams):
    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = Cache(lambda w: word_features(w, params), 200_000)
        for rows in batches:
            # as bytes: lists of numbers would take ten times the driver's memory
            found = [np.array([i for w in document_words(t) for i in cache[w]], "<i4").tobytes() for t in rows["text"]]
            yield pd.DataFrame({"positive": rows["positive"], "features": found})

    return features


def _logistic(f: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(f, -30, 30)))


def telling_features(positive: list[np.ndarray], unlabelled: list[np.ndarray], params: PuParams) -> tuple[np.ndarray, np.ndarray]:
    """Mask of the features whose share of documents is beyond chance higher among the positives,
    and their log ratios of shares, from which the fit starts.

    A text has hundreds of words seen in few documents; fitted weights on those
    would drown the words that matter in long texts.
    """

    def share(rows: list[np.ndarray]) -> np.ndarray:
        return np.bincount(np.concatenate([np.unique(r) for r in rows]), minlength=params.dimensions) / len(rows)

    p, u = share(positive), share(unlabelled)
    n, m = len(positive), len(unlabelled)
    both = (p * n + u * m + 1) / (n + m + 2)
    error = np.sqrt(both * (1 - both) * (1 / n + 1 / m))
    mask = p - u > params.errors * error
    return mask, np.log((p * n + 1) / (n + 2))[mask] - np.log((u * m + 1) / (m + 2))[mask]


def fit_risk(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, params: PuParams, seed: int = 7
) -> PuModel:
    """Minimise the non-negative risk by mini-batches with Adam; the whole sample is in memory."""
    random = np.random.default_rng(seed)
    bias = float(np.log(prior / (1 - prior)))
    bias_first = bias_second = 0.0
    steps = max(1, len(unlabelled) // params.batch)
    each = max(1, min(len(positive), params.batch // 2))
    telling, weights = telling_features(positive, unlabelled, params)
    number = np.cumsum(telling) - 1
    positive = [number[r[telling[r]]] for r in positive]
    unlabelled = [number[r[telling[r]]] for r in unlabelled]
    size = int(telling.sum())
    first, second = np.zeros(size), np.zeros(size)
    count = 0

    def flat(rows: list[np.ndarray]):
        sizes = np.array([len(r) for r in rows])
        return np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(rows)), sizes)

    for epoch in range(params.epochs):
        rate = params.rate * (1 - epoch / params.epochs)
        order = random.permutation(len(unlabelled))
        for step in range(steps):
            chosen = random.choice(len(positive), each, replace=False)
            drawn = order[step :: steps][: 2 * params.batch]
            rows = [positive[i] for i in chosen] + [unlabelled[i] for i in drawn]
            index, owner = flat(rows)
            f = np.bincount(owner, weights[index], len(rows)) + bias
            p, u = f[:each], f[each:]
            # slopes of l(f) = log(1 + exp(-f)) and of l(-f)
            as_positive, as_negative = -_logistic(-p) / each, _logistic(p) / each
            as_unlabelled = _logistic(u) / max(1, len(u))
            bracket = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
            if bracket >= 0:
                slope = np.concatenate([prior * as_positive - prior * as_negative, as_unlabelled])
            else:
                slope = np.concatenate([prior * as_negative, -as_unlabelled])
            g = np.bincount(index, slope[owner], size) + params.decay * weights
            gb = float(slope.sum())
            count += 1
            first += 0.1 * (g - first)
            second += 0.001 * (g * g - second)
            bias_first += 0.1 * (gb - bias_first)
            bias_second += 0.001 * (gb * gb - bias_second)
            c1, c2 = 1 - 0.9**count, 1 - 0.999**count
            weights = np.maximum(0, weights - rate * (first / c1) / (np.sqrt(second / c2) + 1e-8))
            bias -= rate * (bias_first / c1) / (np.sqrt(bias_second / c2) + 1e-8)
    # the share of unlabelled texts above zero is to be the class prior, but never without ``least`` evidence
    above = np.array([weights[r].sum() for r in unlabelled])
    bias = -max(float(np.quantile(above, 1 - prior)), params.least)
    full = np.zeros(params.dimensions, np.float32)
    full[telling] = weights
    return PuModel(full, bias, params)


def fit(documents: DataFrame, labels: DataFrame, params: PuParams = PuParams()) -> PuModel:
    """Fit on a bounded sample of the learning folds (fold other than 0).

    The sample takes the rows whose id hashes lowest, positives and unlabelled
    apart; its bounds are ``most_positive`` and ``most_unlabelled``, and only
    these feature lists reach the driver. A document labelled twice is toxic if
    any label says so. Without any positive, the model says 0 to everything.
    """
    marks = (
        labels.filter((fold("doc_id", params.folds) != 0) & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    learning = (
        documents.filter(fold("doc_id", params.folds) != 0)
        .select("doc_id")
        .distinct()
        .join(marks, "doc_id", "left")
        .withColumn("positive", F.coalesce(F.col("toxic") == 1, F.lit(False)))
        .withColumn("bare", F.col("toxic").isNull())
        .withColumn("place", (F.xxhash64("doc_id").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64))
    )
    total = learning.agg(
        F.count(F.when(F.col("positive"), 1)).alias("positive"),
        F.count(F.when(~F.col("positive"), 1)).alias("others"),
        F.count(F.when(F.col("bare"), 1)).alias("bare"),
        F.count("toxic").alias("marked"),
    ).first()
    if not total["positive"] or not total["others"]:
        return PuModel(np.zeros(params.dimensions, np.float32), -30.0 if not total["positive"] else 0.0, params)
    # rows without a label come first; labelled negatives fill the sample up where those are too few
    negatives = total["others"] - total["bare"]
    share = (
        F.when(F.col("positive"), params.most_positive / total["positive"])
        .when(F.col("bare"), params.most_unlabelled / max(1, total["bare"]))
        .otherwise(max(0, params.most_unlabelled - total["bare"]) / max(1, negatives))
    )
    # about most_positive + most_unlabelled ids at any size of the corpus, so they may be broadcast
    chosen = learning.filter(F.col("place") < share).select("doc_id", "positive")
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy("doc_id", "positive").agg(F.min("text").alias("text"))
    rows = sample.select("positive", "text").mapInPandas(_features_of(params), "positive boolean, features binary").collect()
    positive = [np.frombuffer(r["features"], "<i4") for r in rows if r["positive"]]
    unlabelled = [np.frombuffer(r["features"], "<i4") for r in rows if not r["positive"]]
    if not positive or not unlabelled:
        return PuModel(np.zeros(params.dimensions, np.float32), -30.0 if not positive else 0.0, params)
    prior = min(0.9, max(1e-4, total["positive"] / total["marked"]))
    return fit_risk(positive, unlabelled, prior, params)


def score_column(documents: DataFrame, model: PuModel, text: str = "text") -> Column:
    """Probability of being toxic from the whole text; texts without words get the bias alone.

    The broadcast model has a fixed size, ``dimensions`` floats.
    """
    # a broadcast travels without the code of its classes, so it holds an array and nothing else
    shared = documents.sparkSession.sparkContext.broadcast(model.weights)
    bias, params = model.bias, model.params

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = shared.value
        cache = Cache(lambda w: float(weights[word_features(w, params)].sum()))
        value = cache.__getitem__
        for texts in batches:
            sums = np.array([bias + sum(map(value, document_words(t))) for t in texts], dtype=float)
            yield pd.Series(_logistic(sums))

    return score(F.col(text))


def toxicity(documents: DataFrame, labels: DataFrame, params: PuParams = PuParams()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (score >= 0.5).

    Null and empty texts get the score of a text without words. A null id is in
    no fold: its row is never learned from and ``held_out`` is false. Repeated
    rows are scored each; other columns are ignored. Without documents the
    result is empty, without toxic labels every score is close to 0.
    """
    model = fit(documents, labels, params)
    scored = documents.select(
        "doc_id",
        F.coalesce(fold("doc_id", params.folds) == 0, F.lit(False)).alias("held_out"),
        score_column(documents, model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(documents: DataFrame, labels: DataFrame, params: PuParams = PuParams(), limit: float = 0.5) -> DataFrame:
    """The documents scored below ``limit``, with all their columns.

    Null and empty texts are scored by the bias alone, which keeps them; rows
    without an id are scored like others and never learnt from; repeated rows
    stay or go together; no documents give none.
    """
    return documents.filter(score_column(documents, fit(documents, labels, params)) < limit)
