"""Document chunking: one row a document in, one row a chunk out."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import ws_trim

CAP = 3500  # characters; longer chunks are cut again


def _solid(parts: Column, text: Column) -> Column:
    """Trimmed, non-empty parts; the text itself if there is none."""
    kept = F.filter(F.transform(parts, ws_trim), lambda p: p != "")
    return F.when(F.size(kept) == 0, F.array(text)).otherwise(kept)


def fixed(text: Column, size: int, overlap: int = 0) -> Column:
    step, n = size - overlap, F.length(text)
    last = F.greatest(F.lit(0), F.ceil((n - size) / step).cast("int")) * step
    parts = F.transform(F.sequence(F.lit(0), last, F.lit(step)), lambda i: F.substring(text, i + 1, F.lit(size)))
    return F.when(n <= size, F.array(text)).otherwise(_solid(parts, text))


def paragraphs(text: Column) -> Column:
    return _solid(F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), "\n\n", -1), text)


def headings(text: Column) -> Column:
    return _solid(F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), r"(?m)(?=^#{1,6}\s)", -1), text)


def pack_sentences(text: str | None, size: int) -> list[str] | None:
    """Whole sentences, as many to a chunk as fit ``size`` bytes."""
    if text is None:
        return None
    found = [s for s in (p.strip() for p in re.split(r"(?<=[.!?])(?<![.!?]\s)\s+", text)) if s]
    out: list[str] = []
    for s in found:
        if out and len(out[-1].encode()) + 1 + len(s.encode()) <= size:
            out[-1] += " " + s
        else:
            out.append(s)
    return out or [text]


def sentences(text: Column, size: int) -> Column:
    @F.pandas_udf("array<string>")
    def packed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: pack_sentences(t, size))

    return packed(text)


def chunk(df: DataFrame, strategy: str, id_col: str = "id", text: str = "text", size: int = 1000, overlap: int = 0, keep: list[str] = ()) -> DataFrame:
    """chunk_id, source_id, chunk_index, chunk_total, chunk_strategy, chunk, and
    the columns ``keep`` of the document (its metadata)."""
    if strategy not in ("fixed", "sentence", "paragraph", "heading"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if overlap < 0 or strategy == "fixed" and (size <= 0 or overlap >= size):
        raise ValueError("needs 0 <= overlap < size")
    t = F.col(text)
    parts = {"fixed": lambda: fixed(t, size, overlap), "sentence": lambda: sentences(t, size or 1000), "paragraph": lambda: paragraphs(t), "heading": lambda: headings(t)}[strategy]()
    # parts of a fixed size within the cap, and short texts, are never cut again
    capped = F.col("__parts")
    if strategy != "fixed" or size > CAP:
        cut = F.flatten(F.transform(F.col("__parts"), lambda p: fixed(p, CAP)))
        capped = F.when(F.exists("__parts", lambda p: F.length(p) > CAP), cut).otherwise(F.col("__parts"))
    rows = df.select(F.col(id_col).cast("string").alias("source_id"), parts.alias("__parts"), *keep).select("source_id", capped.alias("parts"), *keep)
    each = rows.select("source_id", *keep, F.size("parts").alias("chunk_total"), F.posexplode("parts").alias("chunk_index", "chunk"))
    return each.select(F.concat_ws("-chunk-", "source_id", F.col("chunk_index").cast("string")).alias("chunk_id"), "source_id", "chunk_index", "chunk_total", F.lit(strategy).alias("chunk_strategy"), "chunk", *keep)
