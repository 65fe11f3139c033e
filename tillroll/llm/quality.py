"""Ordinal quality classifier: a cumulative-link regression on graded ratings.

P(grade >= k) = sigmoid(s - t_k) with one score s per text, a sum of weights of
its hashed features that all grades share, and ordered thresholds t_1 < t_2 <
...; the gaps between thresholds are positive by their form. The fit takes at
most ``max_rows`` labelled documents (features only reach the driver); scoring
takes every whole text where it lies.

Ratings of the labels table: 0 for bad quality, 1 for good quality that is
toxic, 2 for good and clean. Null quality is no rating; null toxic counts as 0.
A null text is scored as an empty one. Repeated rows and null ids are scored
like others. Without ratings all scores are 0 and every document is accepted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import SMALL_SLICE, prepare, row_slices, text_column, texts_of, tidy
from tillroll.llm.features import Adam, Design, Scorer, labelled_features

GRADES = 3
MAX_ROWS = 8_000   # labelled documents of a fit
MIN_ROWS = 5       # a feature in fewer of them gets no weight
ROUNDS = 400
RIDGE = 1e-4
ACCEPT = 0.5       # least P(grade >= 1) of an accepted document; of P(grade >= 2) in the pipeline


def rating() -> Column:
    good = F.col("quality") == 1
    return F.when(~good, 0).when(good & (F.coalesce(F.col("toxic"), F.lit(0)) == 1), 1).when(good, 2)


@dataclass
class OrdinalModel:
    weights: np.ndarray      # by place
    thresholds: np.ndarray   # ascending

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... in columns."""
        return 1 / (1 + np.exp(-(scores[:, None] - self.thresholds)))


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_grades: int = GRADES, min_rows: int = MIN_ROWS) -> OrdinalModel:
    design = Design(rows, grades, n_grades, min_rows)
    w = np.zeros(len(design.places))
    counts = np.bincount(grades, minlength=n_grades) + 0.5
    above = counts[::-1].cumsum()[::-1][1:]
    t = np.log((counts.sum() - above) / above) if len(rows) else np.zeros(n_grades - 1)
    first, gaps = t[:1].copy(), np.log(np.maximum(np.diff(t), 1e-3))  # t_k = t_1 + sums of exp(gaps)
    adam = Adam()
    for _ in range(ROUNDS if len(rows) else 0):
        t = first[0] + np.append(0, np.cumsum(np.exp(gaps)))
        # P(y = k) = F_k - F_(k+1), F_k = sigmoid(s - t_k), F_0 = 1, F_n = 0
        s = design.times(w)
        f = np.column_stack([np.ones(len(s)), 1 / (1 + np.exp(-np.clip(s[:, None] - t, -30, 30))), np.zeros(len(s))])
        slope = f * (1 - f)
        i = np.arange(len(s))
        p = np.maximum(f[i, grades] - f[i, grades + 1], 1e-12)
        ds = -(slope[i, grades] - slope[i, grades + 1]) / p / len(s)
        dt = np.zeros((len(s), n_grades + 1))
        dt[i, grades] += slope[i, grades] / p / len(s)
        dt[i, grades + 1] -= slope[i, grades + 1] / p / len(s)
        dt = dt.sum(axis=0)[1:n_grades]
        w = adam("w", w, design.back(ds) + RIDGE * w, 0.1)
        gap_slopes = np.exp(gaps) * dt[::-1].cumsum()[::-1][1:]
        first, gaps = adam("t", first, np.array([dt.sum()]), 0.1), adam("g", gaps, gap_slopes, 0.1)
        adam.step += 1
    t = first[0] + np.append(0, np.cumsum(np.exp(gaps))) if len(rows) else np.zeros(n_grades - 1)
    return OrdinalModel(design.spread(w), t)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, min_rows: int = MIN_ROWS) -> OrdinalModel:
    return fit_ordinal(*labelled_features(docs, labels, rating(), max_rows), min_rows=min_rows)


def score(docs: DataFrame, model: OrdinalModel) -> Column:
    """The score of each text, as a column over ``docs``."""
    prepare(docs.sparkSession)
    scorer = docs.sparkSession.sparkContext.broadcast(Scorer(model.weights[:, None]))

    @F.arrow_udf("double")
    def latent(texts: pa.Array) -> pa.Array:
        return pa.array(scorer.value(texts)[0][:, 0])

    return latent(text_column())


def tail(s: Column, model: OrdinalModel, k: int) -> Column:
    """P(grade >= k) of a score column."""
    return 1 / (1 + F.exp(F.lit(float(model.thresholds[k - 1])) - s))


def grade_documents(docs: DataFrame, model: OrdinalModel, accept: float = ACCEPT) -> DataFrame:
    """doc_id, score, p_ge_1, p_ge_2, ..., expected_grade, accepted."""
    tails = [tail(F.col("score"), model, k + 1).alias(f"p_ge_{k + 1}") for k in range(len(model.thresholds))]
    graded = docs.select("doc_id", score(docs, model).alias("score")).select("doc_id", "score", *tails)
    expected = sum((F.col(f"p_ge_{k + 1}") for k in range(len(tails))), F.lit(0.0))
    return graded.withColumn("expected_grade", expected).withColumn("accepted", F.col("p_ge_1") >= accept)


def accepted(docs: DataFrame, model: OrdinalModel, accept: float = ACCEPT) -> DataFrame:
    """The documents whose grade is the highest, good and clean, by its tail
    probability, with all their columns: toxic ones go too. Batches of rows are
    scored and filtered in the Python task, so that no text waits for its score."""
    prepare(docs.sparkSession)
    scorer = docs.sparkSession.sparkContext.broadcast(Scorer(model.weights[:, None], SMALL_SLICE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch):
                tails = model_tails(scorer.value(texts_of(part))[0][:, 0])
                yield part.filter(pa.array(tails[:, -1] >= accept))

    model_tails = OrdinalModel(np.zeros(0), model.thresholds).tails   # the weights travel once, in the scorer
    return docs.mapInArrow(tidy(run), docs.schema)
