"""Calls to models as Arrow batches: embedding, reranking, and ingestion.

A model is any object with a ``__call__`` on a list of texts; it travels to the
workers, so it must pickle, and opens its connections there.  The offline ones
here are deterministic and need no network.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import chunks, vectors

BATCH = 100  # texts of one call


class HashEmbedder:
    """Words hashed to signed dimensions, of length 1."""

    def __init__(self, dimensions: int = 64):
        self.dimensions = dimensions

    def __call__(self, texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), self.dimensions))
        for row, t in zip(out, texts):
            for w in t.lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                row[h % self.dimensions] += 1 if h >> 40 & 1 else -1
        return (out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-12)).tolist()


class OverlapScorer:
    """The share of a query's words that a text holds."""

    def __call__(self, query: str, texts: list[str]) -> list[float]:
        want = set(query.lower().split())
        return [len(want & set(t.lower().split())) / max(1, len(want)) for t in texts]


def with_retry(call: Callable, attempts: int = 3, wait_s: float = 0.5) -> Callable:
    """The call repeated on ConnectionError, TimeoutError and OSError, waiting
    twice as long each time; the last error is raised."""
    def tried(*args):
        for k in range(attempts):
            try:
                return call(*args)
            except OSError:
                if k + 1 == attempts:
                    raise
                time.sleep(wait_s * 2**k)

    return tried


def embed(df: DataFrame, text: str, embedder, out: str = "vector", attempts: int = 3, wait_s: float = 0.5) -> DataFrame:
    """Adds ``out``: an embedding a text, ``BATCH`` texts a call.  Null stays null."""
    @F.pandas_udf("array<double>")
    def embedded(texts: pd.Series) -> pd.Series:
        call, known = with_retry(embedder, attempts, wait_s), texts.dropna()
        found = [v for i in range(0, len(known), BATCH) for v in call(known.iloc[i : i + BATCH].tolist())]
        return pd.Series(found, index=known.index, dtype=object).reindex(texts.index)

    return df.withColumn(out, embedded.asNondeterministic()(F.col(text)))


def rerank(df: DataFrame, query: str, scorer, top_k: int | None = None, text: str = "content", id_col: str = "id") -> DataFrame:
    """``df`` with ``rerank_score`` and ``rank``, best first, ties by id.  For the
    hits of a search: ranks are one sequence."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        call = with_retry(scorer)
        t = texts.fillna("").tolist()
        return pd.Series([s for i in range(0, len(t), BATCH) for s in call(query, t[i : i + BATCH])], dtype="float64")

    found = df.withColumn("rerank_score", scored.asNondeterministic()(F.col(text)))
    if top_k:
        found = found.orderBy(F.desc("rerank_score"), id_col).limit(top_k)
    return found.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("rerank_score"), id_col)))


def ingest(docs: DataFrame, embedder, base: DataFrame | None = None, strategy: str | None = "paragraph", size: int = 1000, overlap: int = 0, id_col: str = "id", text: str = "text") -> DataFrame:
    """Documents as rows of a collection (id, content, vector, source_id,
    chunk_index, chunk_total): chunked if a strategy is named, embedded, checked,
    and put over ``base`` by id if there is one.  Blank ids become a hash of the
    text, so that a repeated run gives the same rows."""
    named = docs.withColumn(id_col, F.when(F.coalesce(F.trim(F.col(id_col).cast("string")), F.lit("")) != "", F.col(id_col).cast("string")).otherwise(F.md5(text)))
    if strategy:
        rows = chunks.chunk(named, strategy, id_col, text, size, overlap).select(F.col("chunk_id").alias("id"), F.col("chunk").alias("content"), "source_id", "chunk_index", "chunk_total")
    else:
        rows = named.select(F.col(id_col).alias("id"), F.col(text).alias("content"), F.col(id_col).alias("source_id"), F.lit(0).alias("chunk_index"), F.lit(1).alias("chunk_total"))
    done = vectors.checked(embed(rows.where(F.trim("content") != ""), "content", embedder))
    return done if base is None else vectors.upsert(base, done.withColumn("__seq", F.lit(1)), "id", "__seq")


def rag(docs: DataFrame, question: str, embedder, generate: Callable | None = None, top_k: int = 5, style: str = "numbered", metric: str = "cosine", filters: dict | None = None) -> DataFrame:
    """One row: ``question``, ``context`` of the nearest documents, ``sources``
    (their ids, best first) and ``answer``, where a generator of (question,
    context) is given."""
    hits = vectors.vector_search(docs, embedder([question])[0], top_k, metric=metric, filters=filters).select("id", "content", "score")
    sources = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))), lambda r: r.id)
    row = vectors.format_context(hits, style).crossJoin(hits.agg(sources.alias("sources"))).select(F.lit(question).alias("question"), "context", "sources")
    if generate is None:
        return row.withColumn("answer", F.lit(None).cast("string"))

    @F.pandas_udf("string")
    def answered(context: pd.Series) -> pd.Series:
        return context.map(lambda c: with_retry(generate)(question, c))

    return row.withColumn("answer", answered.asNondeterministic()("context"))
