"""Toxic documents by multiple-instance learning: sentences are scored, a document's label is their noisy-or.

Only documents carry labels. A sentence's probability is a logistic function of its words (whole words and
prefixes, hashed); a document is toxic unless all of its sentences are harmless: p = 1 - prod(1 - p_s). The
weights maximise the likelihood of the document labels, so that blame falls on the sentences which explain
them, and the same scores then say where the offending sentences are. A sentence without any word that was
found telling has probability 0, so that length alone never makes a document toxic.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import prepare
from tallyloom.plans.durable import written

SENTENCE = re.compile(r"[^.!?\n]+(?:[.!?]+|\n|$)|[.!?\n]+")
WORD = re.compile(r"\w+")
PREFIXES = range(4, 9)


@dataclass(frozen=True)
class Fit:
    """The classifier is fitted on at most ``documents`` labelled documents (lowest hash of doc_id) of at most
    ``longest`` code points. Features must be ``lift`` times as frequent in
    toxic ones with a log likelihood ratio (G squared) of at least ``surprise``, which chance hardly ever gives;
    the ``features`` strongest are kept."""

    documents: int = 6_000
    longest: int = 20_000
    surprise: float = 14.0
    lift: float = 3.0
    features: int = 20_000
    rounds: int = 300
    rate: float = 0.5
    ridge: float = 2e-3


def held_out(doc_id: Column) -> Column:
    """True for the documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def features_of(word: str) -> list[int]:
    """Hashes of the word and of its prefixes."""
    data = [f"={word}"] + [f"<{word[:n]}" for n in PREFIXES if n < len(word)]
    return [zlib.crc32(d.encode()) for d in data]


def sentences_of(text: str | None) -> list[tuple[int, int]]:
    return [m.span() for m in SENTENCE.finditer(text)] if text else []


def _words(sentence: str) -> set[str]:
    return set(WORD.findall(sentence.lower()))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its distinct features."""
    for batch in batches:
        found = [sorted({f for w in _words(text) for f in features_of(w)}) for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["toxic", "features"])


def _bags(chosen: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per document its sentences with a chosen feature: how many such features each has, and their places."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {int(f): i for i, f in enumerate(chosen)}
        for batch in batches:
            sizes, columns = [], []
            for text in batch.column(1).to_pylist():
                sentences = [
                    sorted(place[f] for w in _words(text[a:b]) for f in features_of(w) if f in place) for a, b in sentences_of(text)
                ]
                sizes.append([len(s) for s in sentences if s])
                columns.append([c for s in sentences for c in s])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, kind), pa.array(columns, kind)], names=["toxic", "sizes", "columns"])

    return task


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[int, float]


def _telling(sample: DataFrame, positive: int, total: int, fit: Fit) -> np.ndarray:
    """The sorted features that tell toxic documents from others, counted and chosen by Spark."""
    found = sample.mapInArrow(_features, "toxic int, features array<long>")
    counts = found.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum("toxic").cast("double").alias("hit"), F.sum(1 - F.col("toxic")).cast("double").alias("other")
    )
    hit, other, all_ = F.col("hit"), F.col("other"), F.col("hit") + F.col("other")
    share = positive / total
    lifted = (hit / positive) / ((other + 0.5) / (total - positive))

    def part(n: Column, expected: Column) -> Column:
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    surprise = 2 * (part(hit, all_ * share) + part(other, all_ * (1 - share)))
    strong = counts.where(hit > 0).withColumn("surprise", surprise).where((F.col("surprise") >= fit.surprise) & (lifted >= fit.lift))
    best = strong.orderBy(F.desc("surprise"), "feature").limit(fit.features).select("feature").toArrow()
    return np.sort(best["feature"].to_numpy())


def _fit(toxic: np.ndarray, sizes: np.ndarray, sentences: np.ndarray, column: np.ndarray, chosen: np.ndarray, fit: Fit) -> Model:
    """Weights from documents (``toxic``), how many instances each has, and how many ``column`` entries each instance has.

    Instances are the sentences with a chosen feature; the others are taken to be harmless.
    """
    bag = np.repeat(np.arange(toxic.size), sizes)
    sentence = np.repeat(np.arange(bag.size), sentences)

    w, b = np.zeros(chosen.size), -4.0
    squares, b_square = np.full(chosen.size, 1e-8), 1e-8
    for _ in range(fit.rounds):
        z = b + np.bincount(sentence, w[column], bag.size)
        p = 1 / (1 + np.exp(-z))
        total = np.bincount(bag, np.logaddexp(0, z), toxic.size)
        # No sentence of a document may have evidence; its label then teaches nothing.
        # Derivative of the negative log likelihood by the total of a document's softplus scores.
        slope = np.where(toxic == 1, -1 / np.maximum(np.expm1(total), 1e-3), 1.0) / toxic.size
        gradient = slope[bag] * p
        gw = np.bincount(column, gradient[sentence], chosen.size) + fit.ridge * w / toxic.size
        gb = gradient.sum()
        squares += gw * gw
        b_square += gb * gb
        w -= fit.rate * gw / np.sqrt(squares)
        b -= fit.rate * gb / np.sqrt(b_square)
    return Model(float(b), {int(f): float(v) for f, v in zip(chosen, w, strict=True)})


def train(docs: DataFrame, labels: DataFrame, fit: Fit | None = None) -> Model:
    """Fit on documents of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) marks 0 or 1 and are not held out.

    Null labels, ids and texts are left out of the fit; of a repeated id one text counts. Without a toxic (or any) document nothing is learned
    and every score is close to 0.
    """
    fit = fit or Fit()
    prepare(docs.sparkSession)
    usable = (
        labels.where("toxic IN (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    texts = docs.select("doc_id", F.col("text").cast("string"))
    fitting = texts.where(F.length("text").between(1, fit.longest)).select("doc_id").distinct()
    # Ids and labels are chosen without the texts, which then need not be shuffled: the sample is bounded.
    chosen = fitting.join(usable, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.documents).toArrow()
    sample = texts.where(F.length("text").between(1, fit.longest)).join(
        F.broadcast(docs.sparkSession.createDataFrame(chosen, "doc_id long, toxic int")), "doc_id"
    )
    # One text of each chosen id, so that repeated ids leave the sample as bounded as it is.
    sample = written(
        sample.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text", "toxic")).alias("one"))
        .select(F.col("one.toxic").cast("int").alias("toxic"), F.col("one.text").alias("text")),
        "labelled",
    )
    total, positive = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not positive or positive == total:
        return Model(-12.0 if not positive else 0.0, {})
    known = _telling(sample, positive, total, fit)
    bags = sample.mapInArrow(_bags(known), "toxic int, sizes array<int>, columns array<int>")
    # The order in which rows arrive must not matter.
    bags = bags.orderBy("toxic", F.size("columns"), "columns", "sizes").toArrow()
    flat = {c: bags[c].combine_chunks() for c in ("sizes", "columns")}
    per_document = flat["sizes"].value_lengths().to_numpy()
    sentences, column = (flat[c].flatten().to_numpy().astype(np.int32) for c in ("sizes", "columns"))
    return _fit(bags["toxic"].to_numpy().astype(np.int64), per_document, sentences, column, known, fit)


class _Scorer:
    def __init__(self, model: Model):
        self.model = model

        @lru_cache(maxsize=200_000)
        def weight(word: str) -> float:
            return sum(model.weights.get(f, 0.0) for f in features_of(word))

        self.weight = weight

    def sentence(self, text: str) -> float:
        """Log-odds of one sentence; without any evidence it is taken to be harmless."""
        weights = [w for w in map(self.weight, _words(text)) if w]
        return self.model.bias + sum(weights) if weights else -np.inf

    def document(self, places: list[tuple[int, int]], text: str | None) -> tuple[float, np.ndarray]:
        """The noisy-or of the sentences, and the probability of each."""
        z = np.array([self.sentence(text[a:b]) for a, b in places])
        return float(-np.expm1(-np.logaddexp(0, z).sum())), np.exp(-np.logaddexp(0, -z))


def _toxic(model: Model) -> Callable[[Iterator[pd.Series]], Iterator[pd.Series]]:
    def task(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = _Scorer(model)
        for texts in batches:
            yield pd.Series([scorer.document(sentences_of(t), t)[0] >= 0.5 for t in texts], dtype=bool)

    return task


def _score(model: Model):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in batches:
            scores, spans = [], []
            for text in batch.column(1).to_pylist():
                places = sentences_of(text)
                whole, p = scorer.document(places, text)
                scores.append(whole)
                spans.append([
                    {"start": a, "end": b, "score": float(s)} for (a, b), s in zip(places, p, strict=True) if s >= 0.5
                ])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, kind)], names=["doc_id", "score", "offending"]
            )

    return task


def harmless(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic; null and empty texts stay."""
    prepare(docs.sparkSession)
    scorer = F.pandas_udf(_toxic(model), "boolean")
    return docs.where(~scorer(F.col("text").cast("string")))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted, offending.

    ``score`` is between 0 and 1; null and empty texts score 0. ``offending`` lists sentences with a
    probability of at least 0.5 (start, end in code points, score). Nothing but the text is looked at;
    repeated rows are scored each, a null doc_id stays null. One pass, no shuffle.
    """
    prepare(docs.sparkSession)
    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _score(model), "doc_id long, score double, offending array<struct<start: long, end: long, score: double>>"
    )
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending",
    )
