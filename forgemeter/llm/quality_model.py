"""Quality scores by regularised quadratic discriminant analysis.

Documents become transformed statistics (logs and square roots of shares). Each
class has a mean and a covariance, shrunk towards the covariance of both classes
and its diagonal; the score compares the Mahalanobis log-densities, computed
with the classes' Cholesky factors. Sums, and sums of products, are aggregated
over all labelled training rows; only those few numbers reach the driver.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgemeter.llm.words import text_bytes
from forgemeter.session import settle

FEATURES = (
    "words", "chars a word", "symbols", "bars", "capital words", "exclamations", "digits",
    "different words", "commonest word", "repeated lines", "words a line", "repeated pairs",
)
SHRINK_TO_BOTH = 0.1
SHRINK_TO_DIAGONAL = 0.1
RIDGE = 1e-4
FOLDS = 3
HELD_OUT = 1
# Log-density differences are large; divided by this, scores keep their order in double precision.
TEMPERATURE = 12.0

_SYMBOLS = "#*$%&<>"


def statistics(data: bytes) -> list[float]:
    """The features of a text; an empty one has the smallest values."""
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    text = data.decode()
    lines = [line for line in text.split("\n") if line.strip()]
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    share = [
        sum(map(text.count, _SYMBOLS)) / n,
        text.count("|") / n,
        sum(map(str.isupper, text.split())) / n,
        text.count("!") / n,
        sum(map(data.count, (b"0", b"1", b"2", b"3", b"4", b"5", b"6", b"7", b"8", b"9"))) / n,
        len(counts) / n,
        max(counts.values()) / n,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        1 - len(pairs) / (n - 1) if n > 1 else 0.0,
    ]
    return [
        np.log1p(n),
        np.log1p(sum(map(len, words)) / n),
        *np.sqrt(share[:8]).tolist(),
        np.log1p(n / max(1, len(lines))),
        float(np.sqrt(share[8])),
    ]


def statistics_column(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(data) for data in text_bytes(texts)], pa.list_(pa.float64()))

    return of.asNondeterministic()(text)


@dataclass
class Discriminant:
    """Per class (0, 1): mean, inverse Cholesky factor, log of its determinant, log prior."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def difference(self, rows: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0, priors included."""
        logs = []
        for k in (0, 1):
            z = (rows - self.means[k]) @ self.factors[k].T
            logs.append(self.constants[k] - 0.5 * (z * z).sum(axis=1))
        return logs[1] - logs[0]

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.difference(rows) / TEMPERATURE, -700, 700)))


def fit(moments: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Discriminant | None:
    """From each class's number of rows, sums and sums of products; None without rows of both classes."""
    if any(k not in moments or moments[k][0] < 2 for k in (0, 1)):
        return None
    size = len(FEATURES)
    total = sum(moments[k][0] for k in (0, 1))
    means, covariances = [], []
    for k in (0, 1):
        n, sums, products = moments[k]
        mean = sums / n
        means.append(mean)
        covariances.append(products / n - np.outer(mean, mean))
    both = sum(moments[k][0] / total * covariances[k] for k in (0, 1))
    factors, constants = [], []
    for k in (0, 1):
        shrunk = (1 - SHRINK_TO_BOTH) * covariances[k] + SHRINK_TO_BOTH * both
        shrunk = (1 - SHRINK_TO_DIAGONAL) * shrunk + SHRINK_TO_DIAGONAL * np.diag(np.diag(shrunk)) + RIDGE * np.eye(size)
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        constants.append(np.log(moments[k][0] / total) - np.log(np.diag(lower)).sum())
    return Discriminant(np.array(means), np.array(factors), np.array(constants))


def moments_of(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """By class, over rows of ``quality`` and ``features``: one aggregation, one short row per class."""
    size = len(FEATURES)
    values = [F.col("features")[i] for i in range(size)]
    cells = [(i, j) for i in range(size) for j in range(i, size)]
    sums = [F.sum(value).alias(f"s{i}") for i, value in enumerate(values)]
    products = [F.sum(values[i] * values[j]).alias(f"p{i}_{j}") for i, j in cells]
    out = {}
    for row in rows.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect():
        matrix = np.zeros((size, size))
        for i, j in cells:
            matrix[i, j] = matrix[j, i] = row[f"p{i}_{j}"]
        out[int(row["quality"])] = (float(row["n"]), np.array([row[f"s{i}"] for i in range(size)]), matrix)
    return out


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, one row per row of ``docs``.

    Learns from all label rows with quality 0 or 1 whose document is not held
    out; null labels and labels of unknown documents are left out, repeated ones
    count each. A null text is empty and scored as such. Without two training
    rows of each class every score is 0.5. Extra columns are ignored. Runs a job.
    """
    rows = settle(
        docs.select(F.col("doc_id").alias("doc_id"), statistics_column(F.col("text")).alias("features")), "statistics"
    )
    wanted = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(
        F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    model = fit(moments_of(rows.join(wanted, "doc_id").select("quality", "features")))

    @F.arrow_udf("double")
    def scored(lists: pa.Array) -> pa.Array:
        if model is None:
            return pa.array(np.full(len(lists), 0.5))
        table = np.array(lists.flatten().to_numpy(zero_copy_only=False)).reshape(-1, len(FEATURES))
        return pa.array(model.score(table))

    score = scored.asNondeterministic()("features")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
