"""Approximate vector search over an inverted file.

Centres are fitted by k-means on a bounded sample; every vector is written to the
folder of its nearest centre, so that a search reads the folders of the
``probes`` nearest centres and nothing else.  With as many probes as centres the
search is exact.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vectors

SAMPLE = 20_000  # vectors, about, that the centres are fitted on
METRICS = ("cosine", "dot", "euclidean")


def _near(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, by squared distance."""
    return (-2 * x @ centres.T + (centres * centres).sum(axis=1)).argmin(axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


def fit_centres(x: np.ndarray, cells: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Lloyd's rounds from a drawn start; a cell that empties keeps its centre."""
    x = np.unique(x, axis=0)
    centres = x[np.random.default_rng(seed).permutation(len(x))[: min(cells, len(x))]].copy()
    for _ in range(rounds):
        at = _near(x, centres)
        n = np.bincount(at, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def build(df: DataFrame, path: str, cells: int = 64, vector: str = "vector", metric: str = "cosine") -> None:
    """Write the index of ``df`` to ``path``.  Rows without a vector, or with one of
    another length than most of the sample's first, are kept in a cell that every search reads."""
    if metric not in METRICS or cells < 1:
        raise ValueError("bad metric or number of cells")
    spark = df.sparkSession
    rate = min(1.0, SAMPLE / max(1, df.count()))
    drawn = df.where(F.col(vector).isNotNull() & (F.pmod(F.xxhash64(vector), F.lit(1_000_003)) < rate * 1_000_003)).select(F.col(vector).cast("array<double>").alias("v")).limit(2 * SAMPLE).collect()
    sizes = [len(r.v) for r in drawn if all(c is not None for c in r.v)]
    size = max(set(sizes), key=sizes.count) if sizes else 0
    whole = [r.v for r in drawn if len(r.v) == size and all(c is not None for c in r.v)]
    x = np.array(whole, float).reshape(len(whole), size)
    centres = fit_centres(_unit(x) if metric == "cosine" else x, cells) if len(x) else np.zeros((0, size))
    shared = spark.sparkContext.broadcast(centres)  # cells times dimensions

    @F.pandas_udf("int")
    def cell(vs: pd.Series) -> pd.Series:
        c = shared.value
        out = np.full(len(vs), -1)
        fit = [i for i, v in enumerate(vs) if v is not None and len(v) == c.shape[1] and len(c) and not pd.isna(v).any()]
        if fit:
            x = np.array([vs.iloc[i] for i in fit], float)
            out[fit] = _near(_unit(x) if metric == "cosine" else x, c)
        return pd.Series(out)

    df.withColumn("__cell", cell(F.col(vector))).write.partitionBy("__cell").parquet(f"{path}/rows")
    told = json.dumps({"metric": metric, "vector": vector, "centres": centres.tolist()})
    spark.range(1).select(F.lit(told).alias("value")).coalesce(1).write.text(f"{path}/centres")


def search(spark: SparkSession, path: str, query: list[float], top_k: int, probes: int = 8, id_col: str = "id", filters: dict | None = None) -> DataFrame:
    """The nearest rows of the ``probes`` nearest cells, as ``vector_search``."""
    told = json.loads(spark.read.text(f"{path}/centres").first().value)
    centres, q = np.array(told["centres"], float), np.array([query], float)
    near = []
    if len(centres):
        q = _unit(q) if told["metric"] == "cosine" else q
        far = -(centres @ q[0]) if told["metric"] == "dot" else ((centres - q) ** 2).sum(axis=1)
        near = np.argsort(far, kind="stable")[:probes].tolist()
    rows = spark.read.parquet(f"{path}/rows").where(F.col("__cell").isin([-1, *near])).drop("__cell")
    return vectors.vector_search(rows.where(F.size(told["vector"]) == len(query)), query, top_k, id_col, told["vector"], told["metric"], filters)
