"""What the two learners share: folds and bounded samples of labelled documents."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column) -> Column:
    """crc32 of doc_id as text, mod 5; 0 for a null doc_id. Fold 0 is held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def label_sample(labels: DataFrame, label: str, most: int) -> tuple[DataFrame, dict[int, int]]:
    """doc_id and y for up to most labelled rows of each class outside fold 0, and the classes' whole counts.

    Rows are taken in hash order, so the sample is the same in each run. Ids with null labels or unlike labels play no
    part; a repeated row counts once.
    """
    one = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).cast("int").alias("y"), F.max(label).alias("_z"))
    usable = one.where((F.col("y") == F.col("_z")) & (fold(F.col("doc_id")) != 0)).select("doc_id", "y")
    counts = {r["y"]: r["count"] for r in usable.groupBy("y").count().collect()}
    order = (F.xxhash64("doc_id"), F.col("doc_id"))  # each task gives its first rows, so no class meets in one task
    return usable.where("y = 0").orderBy(*order).limit(most).union(usable.where("y = 1").orderBy(*order).limit(most)), counts


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """doc_id, y and text (binary) of the sample's documents; the sample is bounded, so it is broadcast."""
    own = docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    return own.join(F.broadcast(sample), "doc_id")


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def platt(p: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0) -> tuple[float, float]:
    """Slope and shift of log odds that make p likeliest for labels y, by Newton steps; the ridge draws to 1 and 0.

    The slope stays positive, so calibration keeps the order of scores; without rows it is the identity.
    """
    z = np.stack([log_odds(p), np.ones(len(p))], axis=1)
    w = np.ones(len(p)) if weight is None else weight * len(weight) / max(float(weight.sum()), 1e-12)
    rest = np.array([1.0, 0.0])
    theta = rest.copy()
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
        step = np.linalg.solve((z * (w * q * (1 - q))[:, None]).T @ z + ridge * np.eye(2), z.T @ (w * (y - q)) - ridge * (theta - rest))
        theta = theta + step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
    return max(0.1, float(theta[0])), float(theta[1])


def calibrated(p: np.ndarray, slope: float, shift: float) -> np.ndarray:
    return 1 / (1 + np.exp(-(slope * log_odds(p) + shift)))
