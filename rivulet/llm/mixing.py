"""Mixing sources to target weights by subset-sum fitting.

Documents are counted by (source, exact length).  A source's budget is first
filled by whole repeats, then by a proportional draw from each length, and the
remainder by a bounded-knapsack program over lengths, whose reachable sums are
the bits of one integer.  Documents of a length are then chosen by seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import Scratch

MAX_REPEATS = 3
CELLS = 1024  # a length's documents are ranked in so many hash cells
EXACT = 8192  # words, at least, about which the knapsack program decides
SOURCES = 1_000_000  # sources whose totals and targets the driver holds


def words(text: str = "text") -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null: 0."""
    spaced = F.translate(F.coalesce(F.col(text), F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.filter(F.split(spaced, " ", -1), lambda w: w != "")).cast("long")


def targets(totals: list[tuple[str | None, int]]) -> dict[str | None, float]:
    """Shares of the total size: weights 1, 2, 3 repeating over the sources by
    code point (null last), none above three times its size; what is cut is
    shared again by weight among the rest."""
    order = sorted(totals, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: i % 3 + 1 for i, (s, _) in enumerate(order)}
    size = dict(order)
    fixed: dict[str | None, float] = {}
    while True:
        free = [s for s in size if s not in fixed]
        left, share = sum(size.values()) - sum(fixed.values()), sum(weight[s] for s in free)
        now = {s: left * weight[s] / share for s in free}
        over = [s for s in free if now[s] > MAX_REPEATS * size[s]]
        if not over:
            return fixed | now
        fixed |= {s: float(MAX_REPEATS * size[s]) for s in over}


def fit(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many copies of each length to take, for a sum of at most ``budget``
    and as near to it as found: a proportional draw, longest lengths first down
    to ``EXACT`` words or four times the longest length, then a bounded knapsack
    over all lengths for the rest, which is exact for what it is given."""
    total = sum(n * c for n, c in zip(lengths, counts))
    if not total or budget <= 0:
        return [0] * len(lengths)
    if budget >= total:
        return list(counts)
    take = [c * budget // total for c in counts]
    left = budget - sum(t * n for t, n in zip(take, lengths))
    order = sorted((i for i in range(len(lengths)) if lengths[i]), key=lambda i: -lengths[i])
    room = max(EXACT, 4 * lengths[order[0]])
    for i in order:  # longest first, down to what the program decides
        more = min(counts[i] - take[i], max(0, left - room) // lengths[i])
        take[i] += more
        left -= more * lengths[i]
    # bounded knapsack over sums up to what is left; a count is split into powers of two
    items = []
    for i in reversed(order):
        spare, k = min(counts[i] - take[i], left // lengths[i]), 1
        while spare > 0:
            items.append((i, min(k, spare)))
            spare, k = spare - k, 2 * k
    mask, sums, first = (1 << left + 1) - 1, 1, np.full(left + 1, -1, np.int32)
    for at, (i, k) in enumerate(items):
        new = (sums << k * lengths[i] & mask) & ~sums
        if new:  # the item that first reaches a sum; each sum is written once
            low = (new & -new).bit_length() - 1
            raw = np.frombuffer((new >> low).to_bytes((new.bit_length() - low + 7) // 8, "little"), np.uint8)
            first[low + np.flatnonzero(np.unpackbits(raw, bitorder="little"))] = at
            sums |= new
        if sums >> left & 1:
            break
    at = sums.bit_length() - 1
    while at:
        i, k = items[first[at]]
        take[i] += k
        at -= k * lengths[i]
    return take


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7) -> DataFrame:
    """One row per input row: ``doc_id, text_hash, size, source, source_size, target, taken``.

    ``taken`` is the words the mix takes of it, repeats counted: a multiple of
    its size from 0 to 3.  Each source's sum is at most its target, and short of
    it by less than its shortest remaining documents allow.  Empty and null
    texts have size 0 and are not taken; the null source is one of the sources,
    the last; repeated rows count each, and which of them is taken is the same to
    the result.  No rows give no rows.  More than ``SOURCES`` sources are refused.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    sized = scratch.cut(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(F.col(text)).alias("text_hash"), words(text).alias("size")).withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_hash")).withColumn("cell", F.pmod(F.shiftright("h", 40), F.lit(CELLS)).cast("int")), "sized")
    by_cell = scratch.cut(sized.groupBy("source", "size", "cell").agg(F.count("*").alias("n")), "cells")
    lengths = by_cell.groupBy("source", "size").agg(F.sum("n").alias("n"))
    totals = [(r.source, r.total) for r in by_cell.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("total")).limit(SOURCES + 1).collect()]
    if len(totals) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources")
    aims = targets(totals)
    plan = spark.createDataFrame([(s, n, aims[s], min(MAX_REPEATS, int(aims[s] // n) if n else 0)) for s, n in totals], "source string, source_size long, target double, whole int")

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size")
        rest = int(pdf.target.iloc[0]) - int(pdf.whole.iloc[0]) * int(pdf.source_size.iloc[0])
        spare = MAX_REPEATS - int(pdf.whole.iloc[0])  # a length's documents may all be taken so often again
        extra = pd.Series(fit([int(x) for x in pdf["size"]], [int(x) * spare for x in pdf.n], rest), index=pdf.index, dtype="int64")
        pdf["whole"], pdf["k"] = pdf.whole + extra // pdf.n, extra % pdf.n
        return pdf[["source", "size", "source_size", "target", "whole", "k"]]

    same = [F.col("a.source").eqNullSafe(F.col("b.source"))]
    drawn = scratch.cut(
        lengths.alias("a").join(plan.alias("b"), same).select("a.*", "b.source_size", "b.target", "b.whole")
        .groupBy("source").applyInPandas(fitted, "source string, size long, source_size long, target double, whole int, k long"), "drawn")
    on = lambda *cols: [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in cols]
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    quota = scratch.cut(
        by_cell.alias("a").join(drawn.alias("b"), on("source", "size")).select("a.*", "b.source_size", "b.target", "b.whole", "b.k")
        .withColumn("k", F.greatest(F.lit(0), F.least("n", F.col("k") - before))), "quota")
    ranked = sized.alias("a").join(quota.alias("b"), on("source", "size", "cell")).select("a.*", "b.source_size", "b.target", "b.whole", "b.n", "b.k")
    rank = F.row_number().over(Window.partitionBy("source", "size", "cell").orderBy("h", "doc_id", "text_hash"))
    taken = F.col("size") * (F.col("whole") + (rank <= F.col("k")).cast("int"))
    scratch.drop(by_cell, drawn)
    scratch.collect()
    return ranked.select("doc_id", "text_hash", "size", "source", "source_size", "target", taken.cast("long").alias("taken"))
