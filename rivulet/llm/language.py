"""Language identification by compression.

Each language gets a raw-content zstandard dictionary made of labelled text; a
document belongs to the language whose dictionary compresses it smallest.  Only letters count, in lower case, with one
space between runs of them.  Texts are compressed whole, in blocks, so that a
long text cannot replace the dictionary by its own history.
"""

from __future__ import annotations

import math
import re
import uuid

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
BLOCK = 4096  # characters compressed at a time
LEVEL = 5
OTHER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """Lower-case letters, other characters as single spaces."""
    return OTHER.sub(" ", (text or "").lower()).strip()


def learn(docs: DataFrame, label: str = "lang", text: str = "text", samples: int = 112, sample_chars: int = 2000, dict_bytes: int = 96 << 10, max_langs: int = 64) -> dict[str, bytes]:
    """Dictionaries by language, from a bounded sample of labelled rows.

    About ``samples`` distinct texts a language (chosen by the hash of the
    text), ``sample_chars`` characters from a place set by that hash, at most
    ``dict_bytes`` in all.  Every label is learned; of more than ``max_langs``
    each has a smaller share, so that all together stay as large as of that many.
    Rows without label, text or letters teach nothing.
    """
    hashed = docs.select(F.col(label).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("h")).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = hashed.groupBy("lang").agg(F.count("*").alias("rows"), F.approx_count_distinct("h").alias("texts")).collect()
    if not counts:
        return {}
    share = min(1.0, max_langs / len(counts))
    samples, dict_bytes = max(min(samples, 32), math.ceil(samples * share)), max(1, int(dict_bytes * share))  # of 32, none is drawn once in 10^13
    rate = F.element_at(F.create_map(*[x for r in counts for x in (F.lit(r.lang), F.lit(min(1.0, samples / max(1, r.texts))))]), F.col("lang"))
    start = 1 + F.pmod(F.shiftright("h", 7), F.greatest(F.length("text") - sample_chars, F.lit(1))).cast("int")
    chosen = hashed.where(F.pmod("h", F.lit(1_000_003)) < rate * 1_000_003).select("lang", "h", F.substring(F.col("text"), start, F.lit(sample_chars)).alias("piece"))
    rows = chosen.groupBy("lang", "h").agg(F.min("piece").alias("piece")).collect()
    pieces: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.h)):
        pieces.setdefault(r.lang, []).append(r.piece)
    return {k: " ".join(map(letters, v)).encode()[:dict_bytes] for k, v in pieces.items()}


class Classifier:
    """Built once in each Python worker."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.by = []
        for k in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.by.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def __call__(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not any(c.isalpha() for c in text):
            return UNKNOWN, 0.0
        text = letters(text)
        blocks = [text[i : i + BLOCK].encode("utf-8", "surrogatepass") for i in range(0, len(text), BLOCK)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in self.by]
        first, second, *_ = [*sorted(sizes), float("inf")]
        margin = 1.0 if len(sizes) == 1 else 1 - first / second
        return self.langs[sizes.index(first)], margin


_built: dict[str, Classifier] = {}


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", min_margin: float = 0.02) -> DataFrame:
    """Adds ``lang_pred``, ``score`` (relative size margin over the next
    language, 0 to 1) and ``rejected`` (margin below ``min_margin``, or ``und``).

    Null, empty and letterless texts are ``und`` with score 0; ties go to the
    first language by name; nothing learned: all ``und``.  Equal texts are
    treated alike, repeated rows each; columns of those names are replaced; no
    rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # at most max_langs * dict_bytes
    name = uuid.uuid4().hex

    @F.pandas_udf("lang_pred string, score double")
    def classify(texts: pd.Series) -> pd.DataFrame:
        made = _built.get(name)
        if made is None:
            _built.clear()
            made = _built[name] = Classifier(shared.value)
        return pd.DataFrame([made(t) for t in texts], columns=["lang_pred", "score"])

    # so marked, a filter on the result is not pushed below, where it would classify every text once more
    found = docs.select("*", classify.asNondeterministic()(F.col(text)).alias("__found"))
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    return found.select(*kept, "__found.lang_pred", "__found.score", rejected("__found.lang_pred", "__found.score", min_margin).alias("rejected"))


def rejected(lang: str, score: str, min_margin: float) -> Column:
    return (F.col(lang) == UNKNOWN) | (F.col(score) < min_margin)


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out.  Null id: 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5, F.lit(0))
