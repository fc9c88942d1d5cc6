"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade > k) = logistic(w.x - theta_k) with one weight vector w for all grades, over hashed words and a few measures of
form, and ordered thresholds theta_0 < theta_1 < ... (kept in order by fitting the first and the logs of the gaps). The
score of a text gives the expected grade and the tail probability P(grade >= ``select_grade``), by which texts are
selected.

The model is fitted on the driver by Adam steps over a bounded sample of rated rows (``SAMPLE`` at most, those with the
smallest hash of their id); its size is fixed by ``DIM``. Scoring covers every whole text.

Defined results: null and empty texts have only the bias and length features; rows without a rating aren't used in the
fit; without two grades in the sample all scores are those of a zero model; repeated rows repeat; an empty table gives
an empty table; only the named columns are read.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, table

DIM, SAMPLE, EPOCHS, RATE, L2 = 1 << 13, 6_000, 12, 0.05, 3e-4
#: The grade that a selected text reaches with at least this probability.
SELECT_GRADE, SELECT_TAIL = 1, 0.5
FORM = 8


class Hasher:
    """Counts of a text as (indices, values); words are hashed once."""

    def __init__(self, dim: int = DIM):
        self.dim, self.known = dim, {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or "").split()
        known = self.known
        if len(known) > 500_000:
            known.clear()
        for w in words if len(words) < 64 else set(words):
            if w not in known:
                known[w] = FORM + zlib.crc32(w.strip(".,;:!?()\"'").lower().encode()) % (self.dim - FORM)
        n = len(words)
        form = self.form(text or "", words)
        if not n:
            return np.arange(FORM), form
        idx, counts = np.unique(np.fromiter(map(known.__getitem__, words), np.int64, n), return_counts=True)
        x = np.log1p(counts)
        return np.concatenate([np.arange(FORM), idx]), np.concatenate([form, x / math.sqrt(float(x @ x))])

    @staticmethod
    def form(text: str, words: list[str]) -> np.ndarray:
        n, chars = len(words), max(1, len(text))
        distinct = len(set(words)) / n if n else 0.0
        repeats = sum(map(str.__eq__, words, words[1:])) / n if n else 0.0
        marks = sum(text.count(c) for c in "|{}<>#*_=~^\\") / chars
        return np.array([1.0, math.log1p(n) / 5, distinct, repeats, min(1.0, 20 * marks), min(1.0, 10 * (text.count(".") + text.count(",")) / chars), min(1.0, chars / max(1, n) / 20), min(1.0, 50 * text.count("\n") / chars)])


@dataclass
class Ordinal:
    grades: int = 3
    weights: np.ndarray = field(default_factory=lambda: np.zeros(DIM))
    first: float = 0.0
    gaps: np.ndarray = field(default_factory=lambda: np.zeros(1))

    @property
    def thresholds(self) -> np.ndarray:
        return self.first + np.concatenate([[0.0], np.cumsum(np.exp(self.gaps))])

    def tails(self, score: float) -> list[float]:
        """P(grade >= k) for k from 1 on."""
        return [1 / (1 + math.exp(-max(-30.0, min(30.0, score - t)))) for t in self.thresholds.tolist()]


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], grades: int = 3, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, l2: float = L2, batch: int = 64) -> Ordinal:
    """rows: (grade, indices, values). Deterministic: batches follow a fixed permutation."""
    model = Ordinal(grades, np.zeros(dim), 0.0, np.zeros(grades - 2))
    if len({g for g, _, _ in rows}) < 2:
        return model
    y = np.array([g for g, _, _ in rows])
    params = np.zeros(dim + grades - 1)
    m, v, t = np.zeros_like(params), np.zeros_like(params), 0
    for epoch in range(epochs):
        order = np.random.default_rng(epoch).permutation(len(rows))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            idx = np.concatenate([rows[i][1] for i in pick])
            val = np.concatenate([rows[i][2] for i in pick])
            row = np.repeat(np.arange(len(pick)), [len(rows[i][1]) for i in pick])
            s = np.bincount(row, weights=params[idx] * val, minlength=len(pick))
            gaps = np.exp(params[dim + 1 :])
            theta = params[dim] + np.concatenate([[0.0], np.cumsum(gaps)])
            tail = 1 / (1 + np.exp(-np.clip(s[:, None] - theta[None, :], -30, 30)))
            full = np.concatenate([np.ones((len(pick), 1)), tail, np.zeros((len(pick), 1))], axis=1)
            g = y[pick]
            r = np.arange(len(pick))
            p = np.maximum(full[r, g] - full[r, g + 1], 1e-9)
            slope = np.concatenate([np.zeros((len(pick), 1)), tail * (1 - tail), np.zeros((len(pick), 1))], axis=1)
            up, down = slope[r, g] / p, slope[r, g + 1] / p
            grad = np.zeros_like(params)
            ds = -(up - down) / len(pick)
            grad[:dim] = np.bincount(idx, weights=ds[row] * val, minlength=dim) + l2 * params[:dim]
            d_theta = np.zeros(grades + 1)
            np.add.at(d_theta, g, up / len(pick))
            np.add.at(d_theta, g + 1, -down / len(pick))
            d_theta = d_theta[1:grades]
            grad[dim] = d_theta.sum()
            grad[dim + 1 :] = [d_theta[k + 1 :].sum() * gaps[k] for k in range(grades - 2)]
            t += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            params -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    model.weights, model.first, model.gaps = params[:dim].copy(), float(params[dim]), params[dim + 1 :].copy()
    return model


def rated(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = SAMPLE) -> DataFrame:
    """(grade, text) of at most bound rated rows. ratings: id and grade."""
    pick = ratings.where(F.col("grade").isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), "grade").groupBy("id").agg(F.max("grade").alias("grade")).orderBy(F.xxhash64("id"), "id").limit(bound)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(pick), "id").select("id", "grade", "text")


def learn(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", grades: int = 3) -> Ordinal:
    def run(batches):
        h = Hasher()
        for b in batches:
            rows = [h(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), b.column(1), pa.array([i.astype("<i4").tobytes() for i, _ in rows], pa.binary()), pa.array([x.astype("<f4").tobytes() for _, x in rows], pa.binary())], ["id", "grade", "i", "x"])

    got = map_texts(rated(docs, ratings, id_col, text_col).withColumn("grade", F.col("grade").cast("int")), run, "id string, grade int, i binary, x binary").toArrow().to_pylist()
    rows = [(r["grade"], np.frombuffer(r["i"], "<i4"), np.frombuffer(r["x"], "<f4").astype(float)) for r in sorted(got, key=lambda r: (r["id"], r["grade"], r["i"], r["x"]))]
    return fit(rows, grades)


def score(docs: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text", select_grade: int = SELECT_GRADE, select_tail: float = SELECT_TAIL) -> DataFrame:
    """One row for each input row: id, expected_grade, tail_probability, selected. Narrow; the model has a fixed size."""

    def run(batches):
        h = Hasher(len(model.weights))
        for b in batches:
            tails = []
            for t in b.column(1).to_pylist():
                i, x = h(t)
                tails.append(model.tails(float(model.weights[i] @ x)))
            tail = [x[select_grade - 1] for x in tails]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sum(x) for x in tails], pa.float64()), pa.array(tail, pa.float64()), pa.array([x >= select_tail for x in tail], pa.bool_())], ["id", "expected_grade", "tail_probability", "selected"])

    return map_texts(docs.select(id_col, text_col), run, f"id {dict(docs.dtypes)[id_col]}, expected_grade double, tail_probability double, selected boolean").withColumnRenamed("id", id_col)


def grades_of(labels: DataFrame) -> DataFrame:
    """The labels as three grades: 0 poor, 1 good but toxic, 2 good."""
    return labels.select("doc_id", F.expr("case when quality = 0 then 0 when toxic = 1 then 1 when quality = 1 then 2 end").alias("grade"))


def op10_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    train = table(spark, sf_dir, "labels").where(F.expr("crc32(cast(doc_id as string)) % 3 <> 1"))
    return score(docs, learn(docs, grades_of(train)))
