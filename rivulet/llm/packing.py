"""Packing token sequences: bounded-space best fit, then merging of leftovers.

Each input partition keeps a fixed number of open windows.  A document's full
windows leave at once; its remainder goes to the open window it fits best; when
none fits, the fullest leaves and a new one opens.  Windows still open at the
end of a partition are merged with those of neighbouring partitions, where
pieces are cut so that windows are full.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

OPEN = 64
MERGED = 32  # neighbouring partitions whose leftovers meet in one task
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
CACHE = 250_000  # words in each of a worker's two generations
NOT_LATIN = re.compile("[\u0130\u0250-\U0010ffff]")
ENDED = re.compile("([a-z\u00e0-\u00f6\u00f8-\u00ff])([.,])(?= |$)")
PLAIN = re.compile("[a-z\u00e0-\u00f6\u00f8-\u00ff]+").fullmatch
# Byte-level tokenizers show a byte by its Latin-1 character, or, where that does
# not print, by the next free one from 256 on.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
BYTE_CHARS = {b: 256 + i for i, b in enumerate(_HIDDEN)}
END = 1


class Encoder(dict):
    """Ids of a text by a tokenizers file, word by word through a bounded cache
    of two generations: words of the older one that come again move on.

    The file lower-cases, and its splitter never joins across a space, tab, line
    feed or carriage return, nor a letter and a full stop or comma; so such
    words can be encoded one at a time, in lower case where that is the same
    before and after the file's normalizer (Latin letters, no special token).
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokens = self.tokenizer.model.tokenize
        self.old: dict[str, bytes] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        text = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ")
        if not NOT_LATIN.search(text) and "<|" not in text:
            text = ENDED.sub(r"\1 \2", text.lower())
        ids = b"".join(map(self.__getitem__, text.split(" ")))
        return np.append(np.frombuffer(ids, "<u4"), np.uint32(END))

    def __missing__(self, word: str) -> bytes:
        """A word of plain letters is one run to the splitter: the model gets its
        bytes' characters at once.  Others go through the whole tokenizer."""
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(word)
        if ids is None:
            if PLAIN(word):
                ids = [t.id for t in self.tokens(word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_CHARS))]
            else:
                ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            ids = array("I", ids).tobytes()
        self[word] = ids
        return ids


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One a worker: its cache serves later tasks too."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Window:
    __slots__ = ("pieces", "used", "number")

    def __init__(self, number: int):
        self.pieces, self.used, self.number = [], 0, number

    def add(self, doc_id, start, total, ids):
        self.pieces.append((doc_id, start, len(ids), total, self.number, self.used, ids))
        self.used += len(ids)


def pack_stream(docs, size: int, base: int, windows: int = OPEN):
    """``docs``: (doc_id, ids).  Yields (piece, is_open); a piece is (doc_id,
    start, length, doc_tokens, sequence_id, offset, ids)."""
    number = base
    by_free: list[tuple[int, int]] = []  # (free, sequence_id), ascending
    at: dict[int, Window] = {}
    for doc_id, ids in docs:
        total = len(ids)
        for start in range(0, total - total % size, size):
            yield (doc_id, start, size, total, number, 0, ids[start : start + size]), False
            number += 1
        start, need = total - total % size, total % size
        if not need:
            continue
        i = bisect_left(by_free, (need, -1))
        if i < len(by_free):
            _, n = by_free.pop(i)
            w = at[n]
        else:
            if len(by_free) >= windows:
                _, n = by_free.pop(0)
                yield from ((p, False) for p in at.pop(n).pieces)
            w = at[number] = Window(number)
            number += 1
        w.add(doc_id, start, total, ids[start:])
        if w.used == size:
            yield from ((p, False) for p in at.pop(w.number).pieces)
        else:
            insort(by_free, (size - w.used, w.number))
    for w in at.values():
        yield from ((p, True) for p in w.pieces)


def merge_leftovers(pieces, size: int, base: int):
    """Lay the pieces end to end and cut at every full window."""
    number, used = base, 0
    for doc_id, start, _, total, _, _, ids in pieces:
        while len(ids):
            part = ids[: size - used]
            yield doc_id, start, len(part), total, number, used, part
            start, ids, used = start + len(part), ids[len(part) :], used + len(part)
            if used == size:
                number, used = number + 1, 0


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", size: int = 2048) -> DataFrame:
    """Pieces of token sequences of at most ``size``: doc_id, start, length,
    doc_tokens, sequence_id, offset and ids (little-endian unsigned 32-bit).

    A document is its ids and then id 1; each id lies in exactly one piece, and
    offsets in a sequence are gapless from 0.  Null and empty texts are that
    single id; repeated rows are packed each; no rows give no rows.  The
    windows of a partition depend on its rows' order alone, which a file scan
    repeats, and are written to the shared folder before they are merged.
    """
    scratch = Scratch(docs.sparkSession, "pack")
    fields = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    kinds = [pa.int64()] * 6 + [pa.binary()]

    def table(rows, **more):
        cols = [*zip(*rows)] or [[]] * 7
        arrays = [pa.array(c, k) for c, k in zip([*cols[:6], [i.astype("<u4").tobytes() for i in cols[6]]], kinds)]
        return pa.RecordBatch.from_arrays([*arrays, *(pa.array(v, k) for v, k in more.values())], names=[*fields, *more])

    def packed(batches):
        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        docs = ((d, encode(t)) for b in batches for d, t in zip(b.column(0).to_pylist(), b.column(1)) for t in (t.as_py(),))
        rows, held = [], 0
        for row in pack_stream(docs, size, part << 32):
            rows.append(row)
            held += row[0][2]
            if held >= 1 << 20:
                yield flush(rows, part)
                rows, held = [], 0
        if rows:
            yield flush(rows, part)

    def flush(rows, part):
        return table([p for p, _ in rows], group=([part // MERGED if o else None for _, o in rows], pa.int64()))

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["sequence_id", "offset"])
        pieces = ((None if r[0] is None or r[0] != r[0] else int(r[0]), *r[1:6], np.frombuffer(r[6], "<u4")) for r in pdf[fields].itertuples(index=False, name=None))
        rows = [*merge_leftovers(pieces, size, (1 << 62) + (int(pdf["group"].iloc[0]) << 32))]
        out = pd.DataFrame([(*r[:6], r[6].astype("<u4").tobytes()) for r in rows], columns=fields)
        return out.astype({"doc_id": "Int64"})

    first = scratch.cut(docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(packed, SCHEMA + ", group long"), "windows")
    closed = first.where("group is null").drop("group")
    return closed.unionByName(first.where("group is not null").groupBy("group").applyInPandas(merged, SCHEMA))
