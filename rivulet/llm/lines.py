"""Line dedup by pairwise alignment.

Documents that share a run of lines long enough to be deleted are paired, their
line hashes aligned by patience diff, and aligned common blocks deleted from the
later document.  Runs are the shortest ones from each line on and up to each
line, so any block of enough words is made of them.  A run pairs each holder
with its first holder, so that pairs grow with runs, not with their squares;
where that alignment leaves the run (lines that cross or recur), the holder is
aligned with all earlier holders.  What goes is what aligning all pairs deletes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

MIN_WORDS = 20
BASE = 0x9E3779B97F4A7C15  # of the run hash; odd, so it has an inverse modulo 2^64


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched positions (i, j), ascending in both: equal ends first, then the
    longest increasing run of lines that are unique on both sides, and again
    between those."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            found.append((m, n))
        if i == m or j == n:
            continue
        ca, cb = Counter(a[i:m]), Counter(b[j:n])
        there = {b[y]: y for y in range(j, n) if cb[b[y]] == 1}
        pairs = [(x, there[a[x]]) for x in range(i, m) if ca[a[x]] == 1 and a[x] in there]
        tails, ends, back = [], [], [-1] * len(pairs)
        for k, (_, y) in enumerate(pairs):
            at = bisect_left(tails, y)
            back[k] = ends[at - 1] if at else -1
            tails[at : at + 1], ends[at : at + 1] = [y], [k]
        chain, k = [], ends[-1] if ends else -1
        while k >= 0:
            chain.append(pairs[k])
            k = back[k]
        lo = (i, j)
        for x, y in reversed(chain):
            found.append((x, y))
            todo.append((lo[0], x, lo[1], y))
            lo = (x + 1, y + 1)
        if chain:
            todo.append((lo[0], m, lo[1], n))
    return sorted(found)


def common_blocks(later: list[int], words: list[int], earlier: list[int], min_words: int) -> list[tuple[int, int]]:
    """[first, last] line ranges of ``later`` in aligned blocks of at least
    ``min_words`` words.  Blank lines (hash 0) only join what they lie between."""
    out, run = [], []
    for i, j in [*patience(later, earlier), (-9, -9)]:
        if run and (i, j) == (run[-1][0] + 1, run[-1][1] + 1):
            run.append((i, j))
            continue
        if run and sum(words[x] for x, _ in run) >= min_words:
            out.append((run[0][0], run[-1][0]))
        run = [(i, j)]
    return out


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def runs_of(hashes: list[np.ndarray], words: list[np.ndarray], min_words: int) -> list[np.ndarray]:
    """(first, last, hash) rows, for each document, of the shortest runs of at
    least ``min_words`` words from each line on and up to each line.  If there
    are any, (-1, -1, hash) stands for the whole document."""
    size = np.array([len(h) for h in hashes])
    n = int(size.sum())
    end = np.repeat(size.cumsum(), size)
    begin = end - np.repeat(size, size)
    h = np.concatenate([np.empty(0, np.int64), *hashes]).astype(np.int64).view(np.uint64) + np.uint64(1)
    told = np.r_[0, np.concatenate([np.empty(0, np.int64), *words]).astype(np.int64).cumsum()]
    ahead = np.r_[np.uint64(0), (h * powers(BASE, n)).cumsum(dtype=np.uint64)]
    back = powers(pow(BASE, -1, 2**64), n)
    at = np.arange(n)
    last = np.searchsorted(told, told[:-1] + min_words, "left") - 1
    first = np.searchsorted(told, told[1:] - min_words, "right") - 1
    f, b = last < end, first >= begin
    both = np.stack(np.divmod(np.unique(np.r_[at[f] * (n + 1) + last[f], first[b] * (n + 1) + at[b]]), n + 1))
    prints = (ahead[both[1] + 1] - ahead[both[0]]) * back[both[0]]
    stops = np.searchsorted(both[0], np.r_[0, size.cumsum()], "left")
    out = []
    for k, stop in enumerate(size.cumsum()):
        i, j, o = stops[k], stops[k + 1], stop - size[k]
        rows = np.stack([both[0, i:j] - o, both[1, i:j] - o, prints[i:j].view(np.int64)], axis=1)
        if len(rows):
            whole = (ahead[stop] - ahead[o]) * back[o] ^ np.uint64(BASE)
            rows = np.concatenate([rows, [[-1, -1, whole.view(np.int64)]]])
        out.append(rows)
    return out


def merged(blocks):
    """Sorted ranges (first, last) as the fewest that hold the same lines."""
    one = "array<struct<first int, last int>>"

    def add(acc, r):
        end = F.get(acc, F.size(acc) - 1)
        joined = F.struct(end["first"].alias("first"), F.greatest(end["last"], r["last"]).alias("last"))
        return F.when(end["last"] + 1 >= r["first"], F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(acc, F.array(r))).cast(one)

    return F.aggregate(F.array_sort(blocks), F.array().cast(one), add)


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` less the deleted lines, and ``removed``, the
    array of (first, last) line numbers deleted from it, apart from one another,
    null if none.

    Lines end at line feeds and are compared without outer white space.  Earlier
    means the smaller (id, text hash); rows with a null id or text, or without a
    word, are kept as they are, and equal rows are treated alike.  A text all of
    whose lines go is empty.  Columns named like ``removed`` are replaced.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    names = [c for c in docs.columns if c != "removed"]
    keyed = docs.select(*names).withColumn("__key", F.when(F.col(doc_id).isNotNull() & F.col(text).isNotNull(), F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("h"))))
    parts = F.transform(F.split(F.col(text), "\n", -1), lambda x: F.btrim(x, F.lit(" \t\r\x0b\x0c")))
    words = F.transform(parts, lambda x: F.when(x == "", 0).otherwise(1 + F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))).cast("int"))
    hashes = F.transform(parts, lambda x: F.when(x == "", F.lit(0).cast("long")).otherwise(F.xxhash64(x)))
    each = keyed.where("__key is not null").select(F.col("__key").alias("key"), hashes.alias("hs"), words.alias("ws"))
    arrays = scratch.cut(each.groupBy("key").agg(F.first("hs").alias("hs"), F.first("ws").alias("ws")), "arrays")

    @F.pandas_udf("array<struct<lo int, hi int, h long>>")
    def runs(hashes: pd.Series, words: pd.Series) -> pd.Series:
        return pd.Series([[*map(tuple, r.tolist())] for r in runs_of(hashes.tolist(), words.tolist(), min_words)], dtype=object)

    held = scratch.cut(arrays.select("key", F.inline(runs("hs", "ws"))), "held")
    shared = scratch.cut(held.groupBy("h").agg(F.min("key").alias("earlier"), F.max("key").alias("end")).where("earlier < end").drop("end"), "shared")
    met = scratch.cut(held.join(shared, "h").where("earlier < key").withColumnRenamed("key", "later"), "met")
    scratch.drop(shared)
    scratch.collect()

    @F.pandas_udf("array<struct<first int, last int>>")
    def blocks(later: pd.Series, words: pd.Series, earlier: pd.Series) -> pd.Series:
        return pd.Series([common_blocks(a.tolist(), w.tolist(), b.tolist(), min_words) for a, w, b in zip(later, words, earlier)], dtype=object)

    def aligned(pairs: DataFrame) -> DataFrame:
        one = scratch.cut(scratch.cut(pairs, "pairs").join(arrays.withColumnRenamed("key", "later"), "later"), "one")
        both = one.join(arrays.select(F.col("key").alias("earlier"), F.col("hs").alias("ehs")), "earlier")
        done = scratch.cut(both.select("later", F.explode(blocks("hs", "ws", "ehs")).alias("b")).distinct(), "blocks")
        scratch.drop(one)
        return done

    firsts = met.select("later", "earlier").distinct()
    found = aligned(firsts)
    gone = found.groupBy("later").agg(F.collect_list("b").alias("gone"))
    whole = F.forall(F.sequence("lo", "hi"), lambda x: F.exists("gone", lambda r: x.between(r["first"], r["last"])))
    left = scratch.cut(met.where("lo >= 0").join(gone, "later", "left").where(F.col("gone").isNull() | ~whole).select("later", "h", F.col("earlier").alias("tried")).distinct(), "left")
    # a copy of a whole document aligns as its first one does
    copies = met.where("lo < 0").select(F.col("later").alias("earlier"))
    others = held.select("h", F.col("key").alias("earlier")).join(copies, "earlier", "left_anti").distinct()
    rest = left.join(others, "h").where("earlier < later and earlier <> tried").select("later", "earlier").distinct()
    cut = found.unionByName(aligned(rest)).groupBy(F.col("later").alias("__key")).agg(merged(F.collect_set("b")).alias("removed"))
    cut = scratch.cut(cut, "cut")
    scratch.keep(cut)
    kept = F.filter(F.split(F.col(text), "\n", -1), lambda x, i: ~F.exists("removed", lambda r: i.between(r["first"], r["last"])))
    done = keyed.join(cut.hint("merge"), "__key", "left").withColumn(text, F.when(F.col("removed").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")))
    return done.select(*names, "removed")
