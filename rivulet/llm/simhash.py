"""Near duplicates by SimHash: pigeonhole blocks, then the Hamming distance.

Two searches share the fingerprints:

* ``linked`` - 64 bits, at most two differing bits, exact.  Four blocks of 16
  bits; a close pair agrees on at least two of them, so it meets under one of
  six 32-bit keys.  Keys of up to ``PAIRWISE`` distinct fingerprints are joined
  with themselves and verified.  Larger keys take an exact linear way: each
  fingerprint is dealt to itself and its 32 one-bit changes outside the key;
  two fingerprints meet there if and only if they differ in two bits or fewer,
  and a meeting point holds at most 33 of them, so its members hang on one.
* ``near_duplicates`` - wide fingerprints for a similarity of 0.8 over five-word
  shingles, where a fixed small distance would miss most pairs.  They propose
  pairs; the shingle sets decide.

Exact copies share a fingerprint and are one class before any join.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import components
from .scratch import Scratch

PAIRWISE = 64
CHUNK = 1 << 16
SEED = 42


def shingle_hashes(text: str | None, size: int):
    """XXH64 of each space-joined shingle of the lower-cased (A-Z) text, in
    chunks of unsigned 64-bit integers.  Fewer words than ``size``: one shingle
    of all of them; no word or null: nothing."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    if len(words) <= size:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
        return
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for i in range(0, len(words) - size + 1, CHUNK):
        part = words[i : i + CHUNK + size - 1]
        yield np.array([digest(join(s), SEED) for s in zip(*(part[k:] for k in range(size)))], dtype=np.uint64)


def fingerprint(text: str | None, size: int = 3) -> int:
    """64 bits; a bit is 1 if set in over half the shingle hashes."""
    ones, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes(text, size):
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0]) if n else 0


def with_fingerprint(docs: DataFrame, text: str = "text", size: int = 3, out: str = "fingerprint") -> DataFrame:
    """Adds ``out`` (long).  Null or blank text: zero."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, size) for t in texts], dtype="int64")

    return docs.withColumn(out, prints(F.col(text)))


def linked(prints: DataFrame, scratch: Scratch, col: str = "fingerprint") -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints within two bits.

    ``prints``: distinct, non-null longs.  The edges' components are those of
    the full link graph; dense keys give spanning edges, not all pairs.
    """
    blocks = [(i, j) for i in range(4) for j in range(i + 1, 4)]
    masks = [sum(0xFFFF << 16 * x for x in b) for b in blocks]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = prints.select(F.col(col).alias("f"), F.posexplode(F.array(*[F.col(col).bitwiseAND(F.lit(m)) for m in signed])).alias("k", "key"))
    size = scratch.cut(keyed.groupBy("k", "key").count().where("count > 1"), "keys")
    met = scratch.cut(keyed.join(size, ["k", "key"]), "met")
    few = met.where(F.col("count") <= PAIRWISE)
    x, y = few.select("k", "key", F.col("f").alias("a")), few.select("k", "key", F.col("f").alias("b"))
    pairs = x.join(y, ["k", "key"]).where("a < b and bit_count(a ^ b) <= 2").select("a", "b")
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(1 << s if s < 63 else -(1 << 63)).cast("long") for s in range(64) if not m >> s & 1]) for m in masks])
    dense = met.where(F.col("count") > PAIRWISE).select("k", "f", F.explode(F.transform(F.element_at(flips, F.col("k") + 1), lambda z: z.bitwiseXOR(F.col("f")))).alias("point"))
    hubs = dense.groupBy("k", "point").agg(F.collect_set("f").alias("fs")).where("size(fs) > 1")
    stars = hubs.select(F.explode("fs").alias("b"), F.array_min("fs").alias("a")).where("a < b").select("a", "b")
    return pairs.unionByName(stars).distinct()


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint (long), component_id``.

    component_id is the smallest id reachable over links of at most two bits.
    Null ids take part as links but are never the smallest unless all are null
    (then component_id is null).  Null, empty and blank texts have fingerprint
    zero and link like any other.  Repeated rows stay; no rows give no rows.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.cut(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", size).drop("text"), "prints")
    classes = scratch.cut(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("rep")), "classes")
    found = components(linked(classes.select("fingerprint"), scratch), scratch)
    told = scratch.cut(classes.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select("fingerprint", "rep", F.coalesce("component", "fingerprint").alias("component")), "told")
    low = scratch.cut(told.groupBy("component").agg(F.min("rep").alias("component_id")), "low")
    label = scratch.cut(told.select("fingerprint", "component").join(low, "component").drop("component"), "label")
    return rows.join(label, "fingerprint").select("doc_id", "fingerprint", "component_id")


# --- similarity 0.8 over five-word shingles -----------------------------------

MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)  # the constants of the public splitmix64 generator
LANES = 32  # 64-bit words of a wide fingerprint
SENT = 100_000  # rows of keys that may be broadcast; beyond, both sides are shuffled


def wide_fingerprint(text: str | None, size: int, lanes: int = LANES) -> tuple[list[int], int] | None:
    """(``lanes`` signed words of bits, how many) of the set of shingles; none where no word is."""
    found = [h for h in shingle_hashes(text, size)]
    if not found:
        return None
    h = np.unique(np.concatenate(found))
    salts = np.array([MIX[0] * (k + 1) % 2**64 for k in range(lanes)], np.uint64)
    ones = np.zeros(64 * lanes, np.int64)
    for i in range(0, len(h), 255):  # as many as a byte can count
        z = h[i : i + 255, None] + salts
        z = (z ^ (z >> np.uint64(30))) * np.uint64(MIX[1])
        z = (z ^ (z >> np.uint64(27))) * np.uint64(MIX[2])
        z ^= z >> np.uint64(31)
        ones += np.add.reduce(np.unpackbits(z.view(np.uint8), axis=1), axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(h)).view(np.int64).tolist(), len(h)


@contextmanager
def small_batches(spark, rows: int = 1000):
    """Arrow batches of fewer rows for the tables written inside, so that a
    worker holds fewer whole texts and keys at once; the setting is put back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def differing(similarity: float, shingles: int = 1 << 30) -> float:
    """Share of the bits in which two sets of that Jaccard similarity differ: the
    angle of large sets of equal size, and up to a quarter more (0.1875 for four
    shingles in five) for the ties in small ones."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi * (1 + 1 / max(4, shingles))


def bits_apart(similarity: float, bits: int, shingles: int, deviations: float) -> int:
    """Hamming distance that pairs of that similarity stay within, but for those
    over so many standard deviations."""
    p = differing(similarity, shingles)
    return math.floor(bits * p + deviations * math.sqrt(bits * p * (1 - p)))


def blocks_of(similarity: float, block_bits: int, missed: float, shingles: int) -> int:
    """How many blocks find all but ``missed`` of the pairs at that similarity."""
    return math.ceil(-math.log(missed) / (1 - differing(similarity, shingles)) ** block_bits)


def near_duplicates(docs: DataFrame, key: str, text: str = "text", size: int = 5, similarity: float = 0.8, missed: float = 0.015) -> DataFrame:
    """(key, group) for the rows in groups of two or more near duplicates.

    ``key``: a non-null column, one row's name.  A pair links if the Jaccard
    similarity of its sets of distinct shingles is at least ``similarity``, which
    is computed for pairs that agree on a block and whose wide fingerprints are
    within ``bits_apart`` (2.5 deviations: 0.6 % of the pairs just at
    ``similarity`` are not).  A block is some bits of the fingerprint, two more than
    the logarithm of the rows, so that it holds less than half a row by chance
    at every size; there are as many blocks as leave ``missed`` of the pairs just
    at ``similarity`` without one.  Sets of few shingles, whose bits tie, have more.

    In a block all rows meet its smallest row, the pivot; only rows that are not
    connected to it are paired with the block's others, so a group of copies
    costs its size, not its square, and no link between groups is lost.  Pairs
    already connected by others are not computed.  One block holds a row at most
    once, so the largest has the share 1 / blocks of the keyed rows; it is sorted
    and streamed with spill.  Equal fingerprints are one row here.  Rows without a
    word never link; no rows give no rows.
    """
    bits = 64 * LANES
    scratch = Scratch(docs.sparkSession, "near")

    @F.pandas_udf("fp array<long>, n int, far int")
    def wide(texts: pd.Series) -> pd.DataFrame:
        found = [wide_fingerprint(t, size) or (None, 0) for t in texts]
        return pd.DataFrame([(fp, n, bits_apart(similarity, bits, n, 2.5)) for fp, n in found], columns=["fp", "n", "far"])

    with small_batches(docs.sparkSession):
        some = docs.where(F.col(text).rlike(r"[^ \t-\r]")).select(F.col(key).alias("key"), wide(F.col(text)).alias("p"))
        rows = scratch.cut(some.select("key", "p.*"), "prints")
    # one node for all rows of equal fingerprints; ids are fixed once written
    nodes = scratch.cut(rows.groupBy("fp").agg(F.min("key").alias("first"), F.max("n").alias("n"), F.max("far").alias("far")).select(F.monotonically_increasing_id().alias("node"), "*"), "nodes")
    block_bits = min(48, max(10, 2 + math.ceil(math.log2(max(2, nodes.count())))))
    most = blocks_of(similarity, block_bits, missed, 4)
    place = np.random.default_rng(17).permuted(np.tile(np.arange(bits), (most, 1)), axis=1)[:, :block_bits]

    @F.pandas_udf("array<long>")
    def keys(prints: pd.Series, shingles: pd.Series) -> pd.Series:
        out, name = [], np.arange(most, dtype=np.int64)
        for i in range(0, len(prints), 128):  # unpacked bits are 64 times their fingerprint
            part = np.array(prints.iloc[i : i + 128].tolist(), np.int64)
            m = np.unpackbits(part.view(np.uint8), axis=1)
            v = np.broadcast_to(name, (len(part), most)).copy()
            for j in range(block_bits):
                v = v << 1 | m[:, place[:, j]]
            out += [v[k, : blocks_of(similarity, block_bits, missed, n)] for k, n in enumerate(shingles.iloc[i : i + 128])]
        return pd.Series(out, dtype=object)

    @F.pandas_udf("binary")
    def shingles(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(np.concatenate([*shingle_hashes(t, size)])).tobytes() for t in texts], dtype=object)

    @F.pandas_udf("boolean")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(x, y):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True)) if min(len(a), len(b)) / max(len(a), len(b)) >= similarity else 0
            out.append(both / (len(a) + len(b) - both) >= similarity)
        return pd.Series(out, dtype=bool)

    # the first 64 bits settle nearly all chance meetings, all bits the others, inside the sort or join
    within = bits_apart(similarity, 64, 4, 3.5)
    apart = " + ".join(f"bit_count(x[{k}] ^ y[{k}])" for k in range(LANES))
    alike_prints = f"bit_count(x[0] ^ y[0]) <= {within} and least(nx, ny) >= {similarity} * greatest(nx, ny) and {apart} <= greatest(fx, fy)"
    w = Window.partitionBy("block")
    keyed = nodes.select("node", F.get("fp", F.lit(0)).alias("c"), F.explode(keys("fp", "n")).alias("block"))
    seen = keyed.select("*", F.min(F.struct("node", "c")).over(w).alias("p"), F.count("*").over(w).alias("n")).where("n > 1 and node <> p.node")
    with small_batches(docs.sparkSession):
        met = scratch.cut(seen.select("block", "node", F.col("p.node").alias("pivot"), F.expr(f"bit_count(c ^ p.c) <= {within}").alias("near"), "n").where("near or n > 2"), "met")
    scratch.collect()

    def prints(end: str, side: str) -> DataFrame:
        return nodes.select(F.col("node").alias(end), F.col("fp").alias(side), F.col("n").alias("n" + side), F.col("far").alias("f" + side))

    def sets_of(pairs: DataFrame, known: DataFrame | None = None) -> DataFrame:
        """(node, its sorted shingle hashes) of the ends of ``pairs``, without those of ``known``."""
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        if known is not None:
            ends = ends.join(known, "node", "left_anti")
        named = scratch.cut(ends.join(nodes.select("node", F.col("first").alias("key")), "node"), "named")
        sent = F.broadcast(named) if named.count() <= SENT else named
        with small_batches(docs.sparkSession, 100):
            texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(sent, "key")
            done = scratch.cut(texts.dropDuplicates(["node"]).select("node", shingles("text").alias("s")), "sets")
        scratch.drop(named)
        return done

    def links(pairs: DataFrame, *sets: DataFrame) -> DataFrame:
        """The pairs (a, b) whose shingle sets are alike."""
        found = sets[0] if len(sets) == 1 else sets[0].unionByName(sets[1])
        with small_batches(docs.sparkSession, 100):
            both = pairs.select("a", "b").join(found.select(F.col("node").alias("a"), F.col("s").alias("x")), "a").join(found.select(F.col("node").alias("b"), F.col("s").alias("y")), "b")
            return scratch.cut(both.where(alike("x", "y")).select("a", "b"), "links")

    def labelled(pairs: DataFrame, known: DataFrame, *ends: str) -> DataFrame:
        """``pairs`` with the components, named c and the end, of their ends."""
        for end in ends:
            pairs = pairs.join(known.select(F.col("node").alias(end), F.col("component").alias("c" + end)), end, "left").withColumn("c" + end, F.coalesce("c" + end, end))
        return pairs

    pairs = met.where("near").select(F.col("node").alias("b"), F.col("pivot").alias("a")).distinct()
    starred = scratch.cut(pairs.join(prints("a", "x"), "a").join(prints("b", "y"), "b").where(alike_prints).select("a", "b", F.expr(apart).alias("d")), "starred")
    sets = sets_of(starred)
    # the nearest one first: it mostly connects the row, and its other pairs need no sets
    sure = links(starred.groupBy("b").agg(F.min(F.struct("d", "a")).alias("m")).select("b", "m.a"), sets)
    known = scratch.cut(components(sure, scratch), "known")
    sure = sure.unionByName(links(labelled(starred, known, "a", "b").where("ca <> cb"), sets))
    known = scratch.cut(components(sure, scratch), "known")
    told = labelled(met.where("n > 2"), known, "node", "pivot").select("block", F.col("node"), F.col("cnode").alias("c"), (F.col("cnode") != F.col("cpivot")).alias("out"))
    blocks = told.groupBy("block").agg(F.max("out").alias("any"), F.count("*").alias("m")).where("any and m > 1").select("block")
    told = scratch.cut(told.join(blocks, "block"), "told")
    scratch.drop(met)
    full = scratch.cut(told.join(prints("node", "x"), "node"), "full")
    scratch.drop(told)
    x = full.where("out").withColumnsRenamed({"node": "a", "c": "ca"}).drop("out")
    y = full.withColumnsRenamed({"node": "b", "c": "cb", "x": "y", "nx": "ny", "fx": "fy"})
    rest = x.join(y, "block").where(f"ca <> cb and (not out or a < b) and {alike_prints}").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = scratch.cut(rest, "rest")
    scratch.drop(full)
    more = sets_of(rest, sets)
    found = scratch.cut(components(sure.unionByName(links(rest, sets, more)), scratch), "found")
    label = nodes.join(found, "node").select("fp", F.col("component").alias("group"))
    alone = nodes.join(found, "node", "left_anti").select("fp", F.col("node").alias("group"))
    named = scratch.cut(rows.select("key", "fp").join(label.unionByName(alone), "fp").select("key", "group"), "groups")
    many = named.groupBy("group").agg(F.count("*").alias("n"), F.min("key").alias("first")).where("n > 1")
    out = scratch.cut(named.join(many, "group").select("key", F.col("first").alias("group")), "out")
    scratch.keep(out)
    return out
