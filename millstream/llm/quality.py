"""Quality of a text by regularised quadratic discriminant analysis over document statistics.

Each class has a mean and a covariance, shrunk towards the pooled covariance and its diagonal. A score is the logistic
of the difference of the two log densities, where the Mahalanobis distances use Cholesky factors made once.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstream.llm.arrow import add_columns

#: Class of each byte: 0 letter in lower case or part of a longer character, 1 upper, 2 digit, 3 blank, 4 line end,
#: 5 sentence marks, 6 other signs, 7 control.
_CLASS = np.zeros(256, np.uint8)
_CLASS[:32] = 7
_CLASS[33:127] = 6
for _k, _s in ((0, b"abcdefghijklmnopqrstuvwxyz'-"), (1, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (2, b"0123456789"), (3, b" \t"), (4, b"\n\r"), (5, b".,;:")):
    _CLASS[list(_s)] = _k


#: What a share counts for before any text is seen, so that a text of a few words isn't an outlier in every share.
PRIOR = 10.0


def _odds(part: float, whole: float, usual: float) -> float:
    """Log odds of a share, pulled towards what is usual in prose by PRIOR observations."""
    return float(np.log((part + PRIOR * usual) / (max(whole - part, 0) + PRIOR * (1 - usual))))


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a whole text; a null text counts as empty."""
    text = text or ""
    raw = text.encode()
    n = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=8)
    words = text.split()
    lines = text.split("\n")
    count, most = Counter(words), 0
    if count:
        most = count.most_common(1)[0][1]
    pairs = len(set(zip(words, words[1:])))
    kinds = Counter(lines)
    repeated = sum(len(k) * (v - 1) for k, v in kinds.items())
    size, total = len(raw), max(len(words), 1)
    ends = sum(w[-1] in ".!?" for w in words)
    signs = sum(not w[-1].isalnum() for w in words)
    single = sum(len(w) == 1 and not w.isalnum() for w in words)
    return [
        float(np.log1p(len(words))),
        float(np.log((len(text) + 60) / (len(words) + 10))),
        _odds(n[1], size, 0.03),
        _odds(n[2], size, 0.005),
        _odds(n[5], size, 0.03),
        _odds(n[6], size, 0.005),
        _odds(n[7], size, 0.002),
        _odds(most, total, 0.06),
        _odds(len(count), total, 0.8),
        _odds(pairs, max(len(words) - 1, 1), 0.97),
        _odds(ends, total, 0.12),
        _odds(signs, total, 0.18),
        _odds(single, total, 0.005),
        _odds(repeated, len(text), 0.02),
        float(np.log((len(words) + 1) / (len(lines) + 1))),
    ]


SIZE = len(statistics(""))


def with_statistics(docs: DataFrame, text: str = "text", out: str = "statistics") -> DataFrame:
    """`docs` with the statistics of the whole text (array of double, replaced if there)."""

    def start():
        return lambda columns: [pa.array([statistics(t) for t in columns[0].to_pylist()], pa.list_(pa.float64()))]

    return add_columns(docs, [text], [T.StructField(out, T.ArrayType(T.DoubleType()))], start)


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log constants of the classes 0 and 1. None: a class without rows."""

    means: list[np.ndarray | None]
    inverse: list[np.ndarray | None]
    constants: list[float]

    @classmethod
    def of_moments(cls, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], shrink: float, ridge: float) -> Discriminant:
        """moments: by class its number of rows, the sum of x and the sum of x x'."""
        if not moments:
            return cls([None, None], [None, None], [0.0, 0.0])
        total = sum(n for n, _, _ in moments.values())
        scatter = {k: m2 - np.outer(m1, m1) / n for k, (n, m1, m2) in moments.items()}
        pooled = sum(scatter.values()) / max(total - len(moments), 1)
        base = np.diag(np.maximum(np.diag(pooled), 1e-3))
        means, inverse, constants = [None, None], [None, None], [0.0, 0.0]
        for k, (n, m1, _) in moments.items():
            cov = (1 - shrink) * scatter[k] / max(n - 1, 1) + shrink * pooled
            factor = np.linalg.cholesky((1 - ridge) * cov + ridge * base)
            means[k], inverse[k] = m1 / n, np.linalg.inv(factor)
            constants[k] = float(np.log(n / total) - np.log(np.diag(factor)).sum())
        return cls(means, inverse, constants)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each row; 0.5 if nothing was learned, the class itself if only one was."""
        if self.means[0] is None or self.means[1] is None:
            only = 0.5 if self.means[0] is self.means[1] else float(self.means[1] is not None)
            return np.full(len(x), only)
        density = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.inverse, self.constants)]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(labelled: DataFrame, label: str = "quality", statistics: str = "statistics", shrink: float = 0.1, ridge: float = 0.05) -> Discriminant:
    """Discriminant from all rows with label 0 or 1.

    Only sums reach the driver: each task adds up x and x x' of its rows, and sums of tasks are added by class and
    position, SIZE * (SIZE + 1) + 1 numbers a class however many rows there are.
    """

    def sums(batches):
        made = {k: np.zeros((SIZE + 1, SIZE + 1)) for k in (0, 1)}
        for batch in batches:
            y = np.array(batch.column(0))
            x = np.array(batch.column(1).flatten(), float).reshape(-1, SIZE)
            x = np.hstack([np.ones((len(x), 1)), x])
            for k in made:
                made[k] += x[y == k].T @ x[y == k]
        for k, m in made.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, k)), pa.array(np.arange(m.size)), pa.array(m.ravel())], names=["k", "at", "v"])

    rows = labelled.filter(F.col(label).isin(0, 1) & F.col(statistics).isNotNull()).select(F.col(label).cast("long"), statistics)
    added = rows.mapInArrow(sums, "k long, at long, v double").groupBy("k", "at").agg(F.sum("v").alias("v")).collect()
    whole = {k: np.zeros((SIZE + 1, SIZE + 1)) for k in (0, 1)}
    for r in added:
        whole[r.k].ravel()[r["at"]] = r.v
    return Discriminant.of_moments({k: (m[0, 0], m[0, 1:], m[1:, 1:]) for k, m in whole.items() if m[0, 0] > 0}, shrink, ridge)


def labels_by_id(labels: DataFrame, label: str, learn: Column, key: str = "doc_id") -> DataFrame:
    """One label for each id to learn from; rows without id or label are left out, and of several labels the largest holds."""
    return labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & learn).groupBy(key).agg(F.max(label).alias(label))


def predict(df: DataFrame, model: Discriminant, statistics: str = "statistics", score: str = "score") -> DataFrame:
    """`df` with the probability of class 1 (column replaced if there). Rows without statistics score as empty texts."""
    empty = globals()["statistics"]("")

    def start():
        def work(columns: list[pa.Array]) -> list[pa.Array]:
            x = np.array([v if v else empty for v in columns[0].to_pylist()], float).reshape(-1, SIZE)
            return [pa.array(model.scores(x), pa.float64())]

        return work

    return add_columns(df, [statistics], [T.StructField(score, T.DoubleType())], start)
