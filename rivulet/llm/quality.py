"""Quality by weak labels.

Heuristic labellers vote good (+1), bad (-1) or abstain (0).  Expectation
maximisation over the counts of all vote patterns estimates each labeller's
accuracy and the share of good documents; the posteriors of a bounded sample
train a linear scorer on hashed features, which then scores every document.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

DIM = 1 << 16
# Chances of -, 0, + for a bad and a good document before any vote is seen; they
# weigh as much as PRIOR_SHARE of the rows, and at most PRIOR_ROWS rows, so that
# with the corpus the estimates become its own.  They say which side is good.
PRIOR = ((0.4, 0.4, 0.2), (0.0001, 0.4999, 0.5))
PRIOR_SHARE, PRIOR_ROWS = 0.1, 1000
LABELLERS = ("symbols", "shouting", "tables", "sentences", "word_length", "repetition")
CACHE = 200_000
SPAN = 400  # words in which repetition is counted, one stretch after the other
SHRINKS = 6  # a longer text that compresses so much repeats whole passages (prose: two to three times)


def _vote(good: bool, bad: bool) -> int:
    return 1 if good else -1 if bad else 0


def votes(text: str | None, words: list[str] | None = None) -> list[int]:
    """The vote of each of ``LABELLERS``; fewer than three words: all abstain."""
    words = (text or "").split() if words is None else words
    n = len(words)
    if n < 3:
        return [0] * len(LABELLERS)
    chars = len(text)
    letters = sum(map(len, re.findall(r"[^\W\d_]+", text)))
    symbols = sum(text.count(c) for c in "#$%&*!|<>{}[]=_~^\\/@+") / chars
    upper = len([w for w in words if len(w) > 1 and w.isupper()]) / n
    bars = (text.count("|") + text.count("\t")) / n
    ends = sum(text.count(c) for c in ".!?;:") + sum(text.count(c) for c in "。！？")
    per_sentence = n / max(1, ends)
    mean = letters / n
    unique = sum(len({*words[i : i + SPAN]}) for i in range(0, n, SPAN)) / n
    again = unique < 0.2
    if n > SPAN and not again:  # whole passages may come again, stretches apart
        raw = text.encode("utf-8", "surrogatepass")
        again = len(raw) > SHRINKS * len(zstandard.compress(raw, 1))
    return [
        _vote(False, symbols > 0.05),
        _vote(False, upper > 0.3),
        _vote(False, bars > 0.2),
        _vote(3 <= per_sentence <= 40, per_sentence > 80 or ends > n),
        _vote(2.5 <= mean <= 12, mean < 2 or mean > 18),
        _vote(False, again),
    ]


class Features:
    """Hashed lower-cased words and word shapes, through a bounded cache."""

    def __init__(self):
        self.known: dict[str, tuple[int, int]] = {}

    def ids(self, words: list[str]) -> np.ndarray:
        known = self.known
        if missing := [w for w in {*words} if w not in known]:
            if len(known) + len(missing) > CACHE:
                known.clear()
                missing = [*{*words}]
            # one pass over all new words; they hold no line feed
            shapes = re.sub(r"\d+", "9", "\n".join(missing))
            shapes = re.sub(r"(.)\1+", r"\1", re.sub(r"(?:[^\W\d_]|×)+", "a", shapes)).split("\n")
            for w, shape in zip(missing, shapes):
                known[w] = (zlib.crc32(w.lower().encode("utf-8", "surrogatepass")) % DIM, zlib.crc32(("\0" + shape).encode("utf-8", "surrogatepass")) % DIM)
        return np.array([known[w] for w in words], np.int64).ravel()

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct features and weights, of Euclidean length 1."""
        ids, n = np.unique(self.ids(words), return_counts=True) if words else (np.empty(0, np.int64), np.empty(0))
        w = np.sqrt(n)
        return ids, w / max(1e-9, np.sqrt((w * w).sum()))


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[float, np.ndarray, np.ndarray]:
    """(share of good, chance of each labeller's votes, posterior of each pattern).

    The chances, (truth, labeller, vote), truth 0 bad and vote 0, 1, 2 for -, 0
    and +, are a labeller's accuracies and how often it abstains; votes are
    taken as independent given the truth.  ``PRIOR`` settles the sides.
    """
    each = np.stack([patterns == v for v in (-1, 0, 1)], axis=-1).astype(float)
    share, n = 0.9, counts.sum()
    prior = np.repeat(np.array(PRIOR)[:, None], patterns.shape[1], axis=1)
    chance = prior
    for _ in range(rounds):
        log = np.einsum("plv,tlv->pt", each, np.log(chance)) + np.log([1 - share, share])
        post = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))
        share = float(np.clip((post @ counts + 1) / (n + 2), 0.01, 0.99))
        seen = np.stack([np.einsum("p,plv->lv", w * counts, each) for w in (1 - post, post)])
        chance = seen + (min(PRIOR_SHARE * n, PRIOR_ROWS) + 1) * np.array([1 - share, share])[:, None, None] * prior
        chance /= chance.sum(axis=-1, keepdims=True)
    return share, chance, post


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = 6, rate: float = 2.0, keep: float = 1e-6) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, both sides weighing the same, by
    AdaGrad over a fixed order."""
    w, bias, square = np.zeros(DIM), 0.0, np.full(DIM, 1e-2)
    order, share = np.random.default_rng(3).permutation(len(rows)), np.clip(y.mean(), 0.01, 0.99) if len(y) else 0.5
    for _ in range(epochs):
        for i in order:
            ids, x = rows[i]
            grad = (1 / (1 + np.exp(-(w[ids] @ x + bias))) - y[i]) * (0.5 / share if y[i] > 0.5 else 0.5 / (1 - share))
            g = grad * x + keep * w[ids]
            square[ids] += g * g
            w[ids] -= rate * 0.1 * g / np.sqrt(square[ids])
            bias -= 0.01 * grad
    return w, bias


_features: list[Features] = []


def quality(docs: DataFrame, text: str = "text", sample: int = 12_000) -> DataFrame:
    """Adds ``votes`` (a sign a labeller), ``posterior`` (of its vote pattern)
    and ``quality`` (the trained scorer, 0 to 1).

    The scorer is trained on about ``sample`` rows, chosen by the hash of the
    text; votes, pattern counts and scores cover all rows and whole texts.  Null, empty and very short texts have no
    votes (``000000``) and the prior as posterior; equal texts score equally.
    Repeated rows count each in the estimates and as one in training.  Columns of
    those names are replaced; no rows give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    rate = min(1.0, sample / max(1, docs.count()))

    @F.pandas_udf("votes string, ids array<int>, x array<float>")
    def look(texts: pd.Series, chosen: pd.Series) -> pd.DataFrame:
        if not _features:
            _features.append(Features())
        out = []
        for t, c in zip(texts, chosen):
            words = (t or "").split()
            ids, x = _features[0](words) if c else (None, None)
            out.append(("".join("-0+"[v + 1] for v in votes(t, words)), ids, x))
        return pd.DataFrame(out, columns=["votes", "ids", "x"])

    h = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    chosen = F.pmod(h, F.lit(1_000_003)) < rate * 1_000_003
    looked = scratch.cut(docs.select(h.alias("h"), look(F.col(text), chosen).alias("l")).select("h", "l.*"), "votes")
    counted = sorted((r.votes, r.n) for r in looked.groupBy("votes").agg(F.count("*").alias("n")).collect())  # at most 3 ** labellers
    names = [p for p, _ in counted]
    patterns = np.array([["-0+".index(c) - 1 for c in p] for p in names]).reshape(-1, len(LABELLERS))
    _, _, post = fit_labellers(patterns, np.array([n for _, n in counted], float))
    posterior = dict(zip(names, post.tolist()))
    # one of each text, by hash, so that a group of copies weighs as one
    rows = looked.where("ids is not null and size(ids) > 0").groupBy("h").agg(F.min("votes").alias("votes"), F.first("ids").alias("ids"), F.first("x").alias("x")).collect()
    rows.sort(key=lambda r: r.h)
    w, bias = train([(np.array(r.ids), np.array(r.x, float)) for r in rows], np.array([posterior[r.votes] for r in rows]))
    shared = spark.sparkContext.broadcast((w.astype(np.float32), bias, posterior))

    @F.pandas_udf("votes string, posterior double, quality double")
    def score(texts: pd.Series) -> pd.DataFrame:
        if not _features:
            _features.append(Features())
        weights, b, known = shared.value
        out = []
        for t in texts:
            words = (t or "").split()
            ids, x = _features[0](words)
            v = "".join("-0+"[k + 1] for k in votes(t, words))
            out.append((v, known[v], float(1 / (1 + np.exp(-(weights[ids] @ x + b))))))
        return pd.DataFrame(out, columns=["votes", "posterior", "quality"])

    scratch.drop(looked)
    kept = [c for c in docs.columns if c.lower() not in ("votes", "posterior", "quality")]
    return docs.select("*", score(F.col(text)).alias("__q")).select(*kept, "__q.votes", "__q.posterior", "__q.quality")
