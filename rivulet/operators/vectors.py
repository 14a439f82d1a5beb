"""Exact vector search, metadata filters, hybrid fusion and collection changes."""

from __future__ import annotations

from collections import Counter
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.core import guard, num

RRF_K = 60


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def score(vector: Column, query: list[float], metric: str = "cosine") -> Column:
    q = F.array(*[F.lit(float(x)) for x in query])
    if metric == "dot":
        return _dot(vector, q)
    if metric == "cosine":
        norm = sum(x * x for x in query) ** 0.5
        return _dot(vector, q) / (F.sqrt(_dot(vector, vector)) * F.lit(norm))
    if metric == "euclidean":
        d = F.transform(F.arrays_zip(vector.alias("a"), q.alias("b")), lambda p: p["a"].cast("double") - p["b"])
        return 1 / (1 + F.sqrt(_dot(d, d)))
    raise ValueError(f"unknown metric {metric!r}")


def metadata_filter(filters: dict | None, dtypes: dict[str, str] | None = None) -> Column:
    """``{field: scalar}`` or ``{field: {$op: value}}``, all ANDed: $eq, $ne,
    $in, $nin, $like by text, $gt, $gte, $lt, $lte by number.  With the columns'
    types, whole numbers and texts are compared as such, which reaches the scan."""
    terms = []
    for name in sorted(filters or {}):
        spec = filters[name] if isinstance(filters[name], dict) else {"$eq": filters[name]}
        kind, c = (dtypes or {}).get(name), F.col(name)
        text, n = c.cast("string"), num(c)
        for op, v in sorted(spec.items()):
            many = v if op in ("$in", "$nin") else [v]
            if kind == "string" and all(isinstance(x, str) for x in many) or kind in ("int", "bigint") and all(type(x) is int for x in many):
                text = n = c
                same = lambda x: x
            elif kind == "double" and op in ("$gt", "$gte", "$lt", "$lte"):
                n, same = c, float
            else:
                text, n, same = c.cast("string"), num(c), lambda x, op=op: float(x) if op in ("$gt", "$gte", "$lt", "$lte") else _text(x)
            terms.append({
                "$eq": lambda: text == same(v), "$ne": lambda: text != same(v),
                "$gt": lambda: n > same(v), "$gte": lambda: n >= same(v), "$lt": lambda: n < same(v), "$lte": lambda: n <= same(v),
                "$in": lambda: text.isin([same(x) for x in v]), "$nin": lambda: ~text.isin([same(x) for x in v]), "$like": lambda: c.cast("string").like(v),
            }[op]())
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def _text(v) -> str:
    return str(v).lower() if isinstance(v, bool) else str(v)


def vector_search(df: DataFrame, query: list[float], top_k: int, id_col: str = "id", vector: str = "vector", metric: str = "cosine", filters: dict | None = None, score_threshold: float = 0.0) -> DataFrame:
    """The ``top_k`` nearest, ties by id; a threshold (0: off) applies after."""
    hits = df.where(metadata_filter(filters, dict(df.dtypes))).withColumn("score", score(F.col(vector), query, metric)).orderBy(F.desc("score"), id_col).limit(top_k)
    return hits.where(F.col("score") >= score_threshold) if score_threshold else hits


def rrf(dense: DataFrame, text: DataFrame, top_k: int, alpha: float, id_col: str = "id") -> DataFrame:
    """Reciprocal rank fusion of two candidate lists (id, score)."""
    if not 0 <= alpha <= 1:
        raise ValueError("alpha is from 0 to 1")
    w = Window.orderBy(F.desc("score"), id_col)
    a = dense.select(id_col, F.row_number().over(w).alias("rank_vec"))
    b = text.select(id_col, F.row_number().over(w).alias("rank_txt"))
    part = lambda share, rank: F.coalesce(F.lit(share) / (RRF_K + F.col(rank)), F.lit(0.0))
    fused = a.join(b, id_col, "full_outer").withColumn("score", part(alpha, "rank_vec") + part(1 - alpha, "rank_txt"))
    return fused.orderBy(F.desc("score"), id_col).limit(top_k)


def candidates(top_k: int) -> int:
    """How many of each list are fused."""
    return max(100, 10 * top_k)


def text_scores(df: DataFrame, query: list[str], id_col: str, text: str, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """BM25 of the documents that hold a query word (lower case, split at white
    space): id, score.  A text's words are counted without being split: runs of
    white space, and what replacing a word between marks takes away."""
    lower = F.lower(F.coalesce(F.col(text), F.lit("")))
    spaced = F.regexp_replace(lower, r"\s+", "  ")  # each word has a space of its own on either side
    rows = df.select(F.col(id_col), F.concat(F.lit(" "), spaced, F.lit(" ")).alias("__t"))
    n = (F.length("__t") - F.length(F.replace(F.col("__t"), F.lit("  "), F.lit(" ")))) + 1
    times = [((F.length("__t") - F.length(F.replace(F.col("__t"), F.lit(f" {q} "), F.lit("")))) / (len(q) + 2)).cast("int") for q in query]
    counted = rows.select(id_col, n.alias("n"), *[c.alias(f"t{i}") for i, c in enumerate(times)])
    s = counted.agg(F.count("*").alias("docs"), F.avg("n").alias("mean"), *[F.sum((F.col(f"t{i}") > 0).cast("int")).alias(f"d{i}") for i in range(len(query))])
    both = counted.where(reduce(lambda x, y: x | y, [F.col(f"t{i}") > 0 for i in range(len(query))])).crossJoin(F.broadcast(s))  # one row
    term = lambda i: F.log(1 + (F.col("docs") - F.col(f"d{i}") + 0.5) / (F.col(f"d{i}") + 0.5)) * F.col(f"t{i}") * (k1 + 1) / (F.col(f"t{i}") + k1 * (1 - b + b * F.col("n") / F.col("mean")))
    total = reduce(lambda x, y: x + y, [term(i) for i in range(len(query))])
    return both.select(id_col, total.alias("score"))


def text_then_vector(df: DataFrame, words: list[str], query: list[float], top_k: int, text: str, id_col: str = "id", vector: str = "vector", metric: str = "cosine") -> DataFrame:
    """The nearest of the documents that hold one of the words."""
    said = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.col(text)), r"\s+", " "), F.lit(" "))
    return vector_search(df.where(reduce(lambda x, y: x | y, [F.contains(said, F.lit(f" {w.lower()} ")) for w in words], F.lit(False))), query, top_k, id_col, vector, metric)


def weighted(dense: DataFrame, text: DataFrame, top_k: int, alpha: float, id_col: str = "id") -> DataFrame:
    """``alpha`` of the vector score and the rest of the text score, summed; a
    document of one list has nothing from the other."""
    if not 0 <= alpha <= 1:
        raise ValueError("alpha is from 0 to 1")
    a, b = dense.select(id_col, F.col("score").alias("score_vec")), text.select(id_col, F.col("score").alias("score_txt"))
    total = alpha * F.coalesce("score_vec", F.lit(0.0)) + (1 - alpha) * F.coalesce("score_txt", F.lit(0.0))
    return a.join(b, id_col, "full_outer").withColumn("score", total).orderBy(F.desc("score"), id_col).limit(top_k)


def hybrid(df: DataFrame, query: list[float], words: list[str], top_k: int, alpha: float = 0.5, mode: str = "rrf", id_col: str = "id", vector: str = "vector", text: str = "content", metric: str = "cosine", filters: dict | None = None) -> DataFrame:
    """id, score and ``fallback_reason``.  ``rrf`` and ``weighted`` fuse vector and
    text candidates, ``prefilter`` ranks the documents with a query word by
    vector, ``dense`` is for stores without text search: it ranks by vector
    alone and says so.  Without words all modes are dense."""
    rows = df.where(metadata_filter(filters, dict(df.dtypes)))
    if mode not in ("rrf", "weighted", "prefilter", "dense"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "dense" or not words:
        why = "text search is not supported; dense results" if words else "no query text; dense results"
        return vector_search(rows, query, top_k, id_col, vector, metric).select(id_col, "score", F.lit(why).alias("fallback_reason"))
    if mode == "prefilter":
        found = text_then_vector(rows, words, query, top_k, text, id_col, vector, metric)
    else:
        n = candidates(top_k)
        dense = vector_search(rows, query, n, id_col, vector, metric).select(id_col, "score")
        said = text_scores(rows, words, id_col, text).orderBy(F.desc("score"), id_col).limit(n)
        found = (rrf if mode == "rrf" else weighted)(dense, said, top_k, alpha, id_col)
    return found.select(id_col, "score", F.lit("").alias("fallback_reason"))


SPARSE = 50  # entries of a sparse vector


def sparse_vector(text: Column) -> Column:
    """struct<indices, values>: term frequencies under FNV-1 hashes of 32 bits of
    the lower-case words, the ``SPARSE`` smallest hashes, summing to 1."""
    @F.pandas_udf("indices array<long>, values array<float>")
    def built(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            counts = Counter(map(fnv1, (t or "").lower().split()))
            top = sorted(counts.items())[:SPARSE]
            whole = sum(n for _, n in top)
            out.append(([i for i, _ in top], [n / whole for _, n in top]))
        return pd.DataFrame(out, columns=["indices", "values"])

    return built(text)


@lru_cache(1 << 16)
def fnv1(word: str) -> int:
    """The public FNV-1a hash of 32 bits."""
    h = 0x811C9DC5
    for b in word.encode():
        h = (h ^ b) * 0x01000193 & 0xFFFFFFFF
    return h


def get_document(df: DataFrame, key, id_col: str = "id") -> DataFrame:
    """One row: ``found``, and the document's columns, null where there is none."""
    row = df.where(F.col(id_col) == key).limit(1).withColumn("found", F.lit(True))
    asked = df.sparkSession.range(1).select(F.lit(key).cast(dict(df.dtypes)[id_col]).alias("__key"))
    return asked.join(row, F.col("__key") == F.col(id_col), "left").select(F.coalesce("found", F.lit(False)).alias("found"), *df.columns)


def scroll(df: DataFrame, limit: int = 100, offset: int = 0, id_col: str = "id", filters: dict | None = None, after=None, without: tuple[str, ...] = ()) -> DataFrame:
    """A page in id order: by ``offset``, or ``after`` an id, which reads on
    without counting; ``without`` names columns (vectors, payloads) to leave out."""
    rows = df.where(metadata_filter(filters, dict(df.dtypes))).drop(*without)
    if after is not None:
        return rows.where(F.col(id_col) > after).orderBy(id_col).limit(limit)
    return rows.orderBy(id_col).offset(offset).limit(limit)


def scroll_page(df: DataFrame, limit: int = 100, offset: int = 0, id_col: str = "id", filters: dict | None = None, without: tuple[str, ...] = ()) -> DataFrame:
    """One row: ``documents`` (the page), ``next_offset`` (null after the last
    page) and ``total``."""
    page = scroll(df, limit, offset, id_col, filters, without=without)
    rows = F.array_sort(F.collect_list(F.struct(id_col, *[c for c in page.columns if c != id_col])), lambda a, b: F.when(a[id_col] < b[id_col], -1).when(a[id_col] > b[id_col], 1).otherwise(0))
    total = df.where(metadata_filter(filters, dict(df.dtypes))).agg(F.count("*").alias("total"))
    return page.agg(rows.alias("documents")).crossJoin(total).select("documents", F.when(F.lit(offset + limit) < F.col("total"), F.lit(offset + limit)).alias("next_offset"), "total")


def checked(docs: DataFrame, dimensions: int | None = None, id_col: str = "id", vector: str = "vector") -> DataFrame:
    """``docs``, raising on an empty id, an empty vector or one of another length."""
    bad_id = F.col(id_col).isNull() | (F.trim(F.col(id_col).cast("string")) == "")
    size = F.coalesce(F.size(vector), F.lit(0))
    wrong = size <= 0 if dimensions is None else size != dimensions
    return docs.withColumn(id_col, guard(bad_id, "a document needs an id", F.col(id_col))).withColumn(vector, guard(wrong, f"vectors need {dimensions or 'some'} dimensions", F.col(vector)))


def upsert(base: DataFrame, changes: DataFrame, id_col: str, seq: str) -> DataFrame:
    """Insert or replace by id; of several changes the highest ``seq`` wins."""
    w = Window.partitionBy(id_col).orderBy(F.desc(seq))
    last = changes.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", seq)
    return base.join(last.select(id_col), id_col, "left_anti").unionByName(last)


def delete(df: DataFrame, id_col: str, ids: list | None = None, filters: dict | None = None) -> DataFrame:
    """What is left.  Ids take precedence; no ids and no filter delete nothing."""
    if ids:
        return df.where(~F.coalesce(F.col(id_col).isin(ids), F.lit(False)))  # a null id is none of them
    return df.where(~F.coalesce(metadata_filter(filters, dict(df.dtypes)), F.lit(False))) if filters else df


def format_context(hits: DataFrame, style: str = "numbered", id_col: str = "id", content: str = "content") -> DataFrame:
    """One row, ``context``: the hits by descending score.  For top-k results."""
    if style == "json":
        items = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col(id_col).alias("id"), F.col(content).alias("content"))))
        return hits.agg(F.to_json(F.transform(items, lambda r: F.struct(r.id.alias("id"), F.round(-r.s, 4).alias("score"), r.content.alias("content")))).alias("context"))
    shape = {"numbered": "[%d] (score: %.4f)\n%s", "markdown": "### Result %d (score: %.4f)\n\n%s", "plain": "%3$s", "xml": '<document index="%d" score="%.4f">\n%s\n</document>'}[style]
    rows = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col(id_col).alias("i"), F.col(content).alias("c"))))
    parts = F.transform(rows, lambda r, i: F.format_string(shape, i + 1, -r.s, r.c))
    return hits.agg(F.array_join(parts, "\n\n").alias("context"))
