"""Quality classifier: regularised quadratic discriminant analysis over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import let, stored
from strata.llm.quality import STATS, words

# Part of each class covariance that is replaced by the pooled variances.
SHRINKAGE = 0.1


def features(text: Column) -> dict[str, Column]:
    """Raw counts of a text; every one is 0 for null and empty text."""
    t = F.coalesce(text, F.lit(""))
    upper = F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    digits = F.length(t) - F.length(F.translate(t, "0123456789", ""))
    return {name: f(text) for name, f in STATS.items()} | {
        "n_upper": upper.cast("bigint"), "n_digits": digits.cast("bigint"),
        "n_distinct": let(words(text), lambda w: F.size(F.array_distinct(w))).cast("bigint"),
    }


def transformed() -> list[Column]:
    """The classifier's inputs: logarithms of lengths and of rates in per cent, so that rare symbols weigh in."""
    per_word = lambda c: F.log1p(100.0 * F.col(c) / F.greatest(F.col("n_words"), F.lit(1)))
    return [
        F.log1p("n_words"), F.log1p(F.col("n_words") / F.greatest(F.col("n_lines"), F.lit(1))),
        F.log1p(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))),
        F.log1p(100.0 * F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1))),
        F.log1p(100.0 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        per_word("n_symbols"), per_word("n_marks"), per_word("n_stutters"), per_word("n_repeat_words"), per_word("n_digits"),
        F.log1p(F.col("n_words") / F.greatest(F.col("n_distinct"), F.lit(1))),
    ]


def document_vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``x``, the array of transformed statistics of the whole text."""
    counts = docs.select(F.col(id_col).alias("doc_id"), *[c.alias(n) for n, c in features(F.col(text_col)).items()])
    return counts.select("doc_id", F.array(*[c.cast("double") for c in transformed()]).alias("x"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and label: the number of rows, their sum and the sum of their outer products, as (label, k, value)."""
    for batch in batches:
        x, y = _matrix(batch.column("x")), np.asarray(batch.column("label"))
        for label in np.unique(y):
            own = np.hstack([np.ones((int((y == label).sum()), 1)), x[y == label]])
            values = (own.T @ own).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(values.size, label), pa.int64()), pa.array(range(values.size), pa.int64()), pa.array(values)],
                ["label", "k", "value"])


@dataclass(frozen=True)
class Discriminant:
    """Two Gaussian classes in standardised coordinates, each with the inverse of its covariance's Cholesky factor."""

    shift: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    whiteners: list[np.ndarray]
    offsets: list[float]  # log prior less half the log determinant

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.shift) / self.scale
        logs = [
            o - 0.5 * np.square((z - m) @ w.T).sum(axis=1) for m, w, o in zip(self.means, self.whiteners, self.offsets)]
        return 1.0 / (1.0 + np.exp(-np.clip(logs[1] - logs[0], -40, 40)))


def fit(training: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant | None:
    """Fit on rows (x, label 0 or 1); None where a class has no row.

    One pass over all rows gives the moments of both classes; only these, whose number the
    number of inputs fixes, come to the driver. Each covariance is drawn towards the
    pooled variances, which keeps it regular where an input is constant within a class.
    """
    sums = training.mapInArrow(_moments, "label bigint, k bigint, value double").groupBy("label", "k").agg(F.sum("value").alias("value"))
    found: dict[int, dict[int, float]] = {0: {}, 1: {}}
    for label, k, value in sums.collect():
        found[label][k] = value
    if not found[0] or not found[1]:
        return None
    d = int(round(len(found[0]) ** 0.5))
    moments = [np.array([found[c][k] for k in range(d * d)]).reshape(d, d) for c in (0, 1)]
    n = [m[0, 0] for m in moments]
    both = moments[0] + moments[1]
    shift = both[0, 1:] / sum(n)
    variance = np.maximum(np.diag(both)[1:] / sum(n) - shift**2, 0)
    scale = np.sqrt(np.where(variance > 1e-12, variance, 1.0))
    means, whiteners, offsets = [], [], []
    for m, rows in zip(moments, n):
        mean = m[0, 1:] / rows
        cov = (m[1:, 1:] / rows - np.outer(mean, mean)) / np.outer(scale, scale)
        cov = (1 - shrinkage) * (cov + cov.T) / 2 + shrinkage * np.eye(d - 1)
        factor = np.linalg.cholesky(cov)
        means.append((mean - shift) / scale)
        whiteners.append(np.linalg.inv(factor))
        offsets.append(float(np.log(rows / sum(n)) - np.log(np.diag(factor)).sum()))
    return Discriminant(shift, scale, means, whiteners, offsets)


def held_out(doc_id: Column) -> Column:
    """Rows that never train: the CRC-32 of the id as text is 1 modulo 3. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def score_quality(docs: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Trains on all rows with a label that are not held out. Ids, sources, languages and labels
    are no inputs. Null and empty texts score as texts of no word. Rows score each by itself; labels that
    repeat count once, those other than 0 and 1 not at all. Without a training row of
    each class every score is 0.5.
    """
    vectors = stored(document_vectors(docs, id_col, text_col), "document-vectors")
    known = labels.select(F.col("doc_id"), F.col(label_col).cast("bigint").alias("label")).where("label in (0, 1)").distinct()
    training = vectors.where(~held_out(F.col("doc_id"))).join(known, "doc_id").select("x", "label")
    model = fit(training, shrinkage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"))
            score = model.score(x) if model is not None and len(x) else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    scored = vectors.mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
