"""Quality classifier: naive Bayes support vectors.

A document is the set of its n-grams: character trigrams of its words with
their blanks, whole words, and whether words repeat the one before (word
bigrams of that shape). Each indicator is scaled by the log-count ratio
of the classes, then a linear hinge-loss model is fitted by dual coordinate
descent. A logistic curve, fitted on rows kept out of the descent, turns
margins into scores.

Features of a word are computed once and kept; a document needs the distinct
words of its whole text only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.llm.common import Cache, fold

#: Shares of words that equal the word before them; each share exceeded is an indicator.
REPEATS = (0.02, 0.1, 0.3)


@dataclass(frozen=True)
class NbSvmParams:
    """``most_each`` bounds the rows of a class the model is fitted on, not the rows it scores."""

    folds: int = 5
    dimensions: int = 1 << 18
    most_each: int = 4000
    smoothing: float = 1.0
    cost: float = 0.5
    passes: int = 12
    threshold: float = 0.3


@dataclass(frozen=True)
class NbSvmModel:
    weights: np.ndarray
    bias: float
    slope: float
    level: float
    params: NbSvmParams


def word_grams(word: str, params: NbSvmParams) -> bytes:
    """Hashed indicators of a word, as the bytes of 32-bit numbers."""
    padded = f" {word} "
    grams = {padded[i : i + 3] for i in range(len(padded) - 2)}
    found = [zlib.crc32(g.encode()) % params.dimensions for g in grams]
    found.append(zlib.crc32(b"word " + word.encode()) % params.dimensions)
    return np.array(found, np.uint32).tobytes()


def even(grams: int) -> float:
    """Factor that makes a margin a mean over the text's indicators, so short and long texts compare."""
    return 20.0 / (grams + 5.0)


def document_grams(text: str | None, cache: Cache) -> np.ndarray:
    """Sorted distinct indicators of the whole text."""
    words = text.split() if text else []
    found = np.frombuffer(b"".join(map(cache.__getitem__, set(words))), np.uint32)
    repeats = sum(map(eq, words, words[1:])) / max(1, len(words))
    marks = [n for n, least in enumerate(REPEATS) if repeats > least]
    return np.unique(np.concatenate([found, np.array(marks, np.uint32)]))


def fit_vectors(rows: list[np.ndarray], good: np.ndarray, params: NbSvmParams, seed: int = 11) -> NbSvmModel:
    """Log-count ratios, dual coordinate descent on four fifths of the rows, score curve on the rest."""
    random = np.random.default_rng(seed)
    order = random.permutation(len(rows))
    kept_out = order[: len(rows) // 5] if len(rows) >= 50 else order
    used = order[len(rows) // 5 :] if len(rows) >= 50 else order
    counts = np.full((2, params.dimensions), params.smoothing)
    for i in used:
        counts[int(good[i])][rows[i]] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    ratio = np.log(share[1] / share[0])
    # one more indicator, always there, is the bias
    scales = [ratio[r] * even(len(r)) for r in rows]
    lengths = np.array([s @ s + 1.0 for s in scales])
    weights, bias, dual = np.zeros(params.dimensions), 0.0, np.zeros(len(rows))
    sign = np.where(good, 1.0, -1.0)
    share_good = min(max(good[used].mean(), 1e-3), 1 - 1e-3)
    upper = np.where(good, params.cost / share_good, params.cost / (1 - share_good)) * 0.5
    for _ in range(params.passes):
        for i in random.permutation(used):
            gradient = sign[i] * (weights[rows[i]] @ scales[i] + bias) - 1.0
            moved = min(max(dual[i] - gradient / lengths[i], 0.0), upper[i])
            step, dual[i] = (moved - dual[i]) * sign[i], moved
            if step:
                weights[rows[i]] += step * scales[i]
                bias += step
    margins = np.array([weights[rows[i]] @ scales[i] + bias for i in kept_out])
    slope, level = fit_curve(margins, good[kept_out])
    return NbSvmModel((weights * ratio).astype(np.float32), bias, slope, level, params)


def fit_curve(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and level of the logistic curve, by Newton steps on softened targets; the slope stays positive."""
    n, m = good.sum(), (~good).sum()
    target = np.where(good, (n + 1) / (n + 2), 1 / (m + 2))
    beta, x = np.array([1.0, 0.0]), np.stack([margins, np.ones_like(margins)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * beta), -2, 2)
    return max(float(beta[0]), 1e-3), float(beta[1])


def margin(weights: np.ndarray, bias: float, grams: np.ndarray) -> float:
    return float(weights[grams].sum()) * even(len(grams)) + bias


def constant(score: float, params: NbSvmParams) -> NbSvmModel:
    return NbSvmModel(np.zeros(params.dimensions, np.float32), 0.0, 1.0, float(np.log(score / (1 - score))), params)


def _grams_of(params: NbSvmParams):
    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = Cache(lambda w: word_grams(w, params), 200_000)
        for rows in batches:
            found = [document_grams(t, cache).astype("<i4").tobytes() for t in rows["text"]]
            yield pd.DataFrame({"good": rows["good"], "grams": found})

    return grams


def fit(documents: DataFrame, labels: DataFrame, params: NbSvmParams = NbSvmParams()) -> NbSvmModel:
    """Fit on a bounded sample of labelled rows outside fold 0.

    Of each class the rows whose id hashes lowest are taken, about
    ``most_each``; only their indicators reach the driver. A document labelled
    twice is good only if every label says so. With one class the score is that
    class's, close to 1 or 0; without labels it is 0.5.
    """
    marks = (
        labels.filter((fold("doc_id", params.folds) != 0) & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    marked = (
        documents.select("doc_id")
        .distinct()
        .join(marks, "doc_id")
        .withColumn("good", F.col("quality") == 1)
        .withColumn("place", (F.xxhash64("doc_id").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64))
    )
    total = marked.agg(
        F.count(F.when(F.col("good"), 1)).alias("good"), F.count(F.when(~F.col("good"), 1)).alias("bad")
    ).first()
    if not total["good"] and not total["bad"]:
        return constant(0.5, params)
    if not total["good"] or not total["bad"]:
        return constant(0.99 if total["good"] else 0.01, params)
    share = F.when(F.col("good"), params.most_each / total["good"]).otherwise(params.most_each / total["bad"])
    # about 2 * most_each ids at any size of the corpus, so they may be broadcast
    chosen = marked.filter(F.col("place") < share).select("doc_id", "good")
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy("doc_id", "good").agg(F.min("text").alias("text"))
    rows = sample.select("good", "text").mapInPandas(_grams_of(params), "good boolean, grams binary").collect()
    good = np.array([r["good"] for r in rows], bool)
    if good.all() or not good.any():
        return constant(0.99 if len(rows) and good.all() else 0.5, params)
    return fit_vectors([np.frombuffer(r["grams"], "<i4") for r in rows], good, params)


def score_column(documents: DataFrame, model: NbSvmModel, text: str = "text") -> Column:
    """Score of the whole text, 0 to 1; the broadcast model has a fixed size, ``dimensions`` floats."""
    # a broadcast travels without the code of its classes, so it holds an array and nothing else
    shared = documents.sparkSession.sparkContext.broadcast(model.weights)
    bias, slope, level, params = model.bias, model.slope, model.level, model.params

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = shared.value
        cache = Cache(lambda w: word_grams(w, params))
        for texts in batches:
            margins = np.array([margin(weights, bias, document_grams(t, cache)) for t in texts], dtype=float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(slope * margins + level, -30, 30))))

    return score(F.col(text))


def quality(documents: DataFrame, labels: DataFrame, params: NbSvmParams = NbSvmParams()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (score >= ``threshold``).

    Null and empty texts get the score of a text without n-grams. A null id is
    in no fold: never learned from, ``held_out`` false. Repeated rows are scored
    each; other columns are ignored. Without documents the result is empty.
    """
    model = fit(documents, labels, params)
    scored = documents.select(
        "doc_id",
        F.coalesce(fold("doc_id", params.folds) == 0, F.lit(False)).alias("held_out"),
        score_column(documents, model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= params.threshold).cast("int"))


def keep_good(documents: DataFrame, labels: DataFrame, params: NbSvmParams = NbSvmParams()) -> DataFrame:
    """The documents scored at ``threshold`` or above, with all their columns.

    Null and empty texts get the score of a text without n-grams; rows without
    an id are scored like others and never learnt from; repeated rows stay or
    go together; no documents give none.
    """
    return documents.filter(score_column(documents, fit(documents, labels, params)) >= params.threshold)
