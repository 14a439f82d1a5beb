"""Media columns: AVI files of motion JPEG.

``write_avi`` stores bytes losslessly: each byte is one quantized DCT
coefficient (the format's unit) of baseline JPEG frames, three 8x8 blocks to a
192-byte unit, under a RIFF header and index.  Coefficients take the size
category 8, whose 256 values stand for the byte values.  ``read_avi`` parses the
RIFF lists and the idx1 index; ``decode_frame`` entropy-decodes a frame, with a
vectorized way for byte-aligned codes; ``luma`` undoes the DCT; ``shots`` cuts where
the difference of neighbouring histograms stands out from those before it.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections import deque
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = 192
FRAME_UNITS = 8
FPS = 25
SHOT = "array<struct<first_frame int, frames int, start_s double, end_s double, peak double>>"
# The zigzag order of ITU-T T.81, figure A.6, from its rule: walk the diagonals, turning at each.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8)))
DCT = np.array([[(0.5 if u else 8**-0.5) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)], np.float32)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


@lru_cache(64)
def _jpeg_head(units: int) -> bytes:
    """Everything before the entropy-coded data: quantizers of 1, 4:4:4, a
    restart after every unit, and one Huffman code, of 8 bits, a table."""
    one_code = bytes([0] * 7 + [1] + [0] * 8 + [8])
    return b"\xff\xd8" + b"".join([
        _segment(0xDB, b"\x00" + b"\x01" * 64),
        _segment(0xC0, struct.pack(">BHHB", 8, 8, 8 * units, 3) + b"".join(bytes([c, 0x11, 0]) for c in (1, 2, 3))),
        _segment(0xC4, b"\x00" + one_code),
        _segment(0xC4, b"\x10" + one_code),
        _segment(0xDD, struct.pack(">H", 1)),
        _segment(0xDA, b"\x03" + bytes([1, 0, 2, 0, 3, 0]) + b"\x00\x3f\x00"),
    ])


def encode_frame(units: np.ndarray) -> bytes:
    """A JPEG image of shape (n, 192) bytes."""
    n = len(units)
    out = np.zeros((n, 2 * UNIT + 2), np.uint8)
    out[:, 1 : 2 * UNIT : 2] = units
    out[:, -2], out[:, -1] = 0xFF, 0xD0 + np.arange(n) % 8
    if (units == 0xFF).any():
        data = b"".join(row[:-2].tobytes().replace(b"\xff", b"\xff\x00") + row[-2:].tobytes() for row in out)
    else:
        data = out.tobytes()
    return _jpeg_head(n) + data[:-2] + b"\xff\xd9"


def _chunk(tag: bytes, body: bytes) -> bytes:
    return tag + struct.pack("<I", len(body)) + body + b"\x00" * (len(body) % 2)


def write_avi(payload: bytes, frame_units: int = FRAME_UNITS) -> bytes:
    """An AVI file of whole 192-byte units; the last frame is filled with spaces."""
    if not payload or len(payload) % UNIT:
        raise ValueError("the payload must be a positive multiple of 192 bytes")
    units = min(frame_units, len(payload) // UNIT)
    full = payload + b" " * (-len(payload) % (UNIT * units))
    frames = [encode_frame(f) for f in np.frombuffer(full, np.uint8).reshape(-1, units, UNIT)]
    largest = max(map(len, frames))
    width, height = 8 * units, 8
    avih = struct.pack("<14I", 1_000_000 // FPS, largest * FPS, 0, 0x10, len(frames), 0, 1, largest, width, height, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIIIhhhh", 0, 0, 0, 0, 1, FPS, 0, len(frames), largest, 0xFFFFFFFF, 0, 0, 0, width, height)
    strf = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 24, b"MJPG", 3 * width * height, 0, 0, 0, 0)
    hdrl = b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf))
    info = b"INFO" + _chunk(b"ICMT", b"payload=%d" % len(payload))
    movi, index, at = [b"movi"], [], 4
    for f in frames:
        movi.append(_chunk(b"00dc", f))
        index.append(b"00dc" + struct.pack("<III", 0x10, at, len(f)))
        at += len(movi[-1])
    body = b"AVI " + _chunk(b"LIST", hdrl) + _chunk(b"LIST", info) + _chunk(b"LIST", b"".join(movi)) + _chunk(b"idx1", b"".join(index))
    return _chunk(b"RIFF", body)


def read_avi(data: bytes) -> tuple[float, list[bytes], int | None]:
    """(frames a second, JPEG frames by the idx1 index, payload bytes if noted)."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    fps, movi, index, noted = float(FPS), None, b"", None
    stack = [(12, min(len(data), 8 + struct.unpack_from("<I", data, 4)[0]))]
    while stack:
        at, end = stack.pop()
        while at + 8 <= end:
            tag, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
            body = at + 8
            if tag == b"LIST":
                kind = data[body : body + 4]
                if kind == b"movi":
                    movi = body
                else:
                    stack.append((body + 4, body + size))
            elif tag == b"avih":
                fps = 1e6 / max(1, struct.unpack_from("<I", data, body)[0])
            elif tag == b"idx1":
                index = data[body : body + size]
            elif tag == b"ICMT" and (m := re.match(rb"payload=(\d+)", data[body : body + size])):
                noted = int(m[1])
            at = body + size + size % 2
    if movi is None:
        raise ValueError("no movi list")
    entries = [struct.unpack_from("<4sIII", index, i) for i in range(0, len(index) - 15, 16)]
    frames = [(off, size) for tag, _, off, size in entries if tag[2:] in (b"dc", b"db")]
    base = movi if frames and data[movi + frames[0][0] : movi + frames[0][0] + 4] == b"00dc" else 0  # some writers count from the file's start
    return fps, [data[base + off + 8 : base + off + 8 + size] for off, size in frames], noted


@lru_cache(64)
def _tables(head: bytes) -> dict:
    """The parsed segments of a JPEG header."""
    t: dict = {"q": {}, "h": {}, "restart": 0}
    at = 2
    while at < len(head):
        marker, size = head[at + 1], struct.unpack_from(">H", head, at + 2)[0]
        body = head[at + 4 : at + 2 + size]
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                n = 64 * (1 + wide)
                t["q"][body[0] & 15] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else np.uint8).astype(np.int32)
                body = body[1 + n :]
        elif marker in (0xC0, 0xC1):
            _, height, width, n = struct.unpack_from(">BHHB", body)
            t["size"], t["parts"] = (height, width), [tuple(body[6 + 3 * i : 9 + 3 * i]) for i in range(n)]
        elif marker in (0xC2, 0xC3):
            raise ValueError("only sequential DCT frames are decoded")
        elif marker == 0xC4:
            while body:
                counts, code, codes, n = body[1:17], 0, {}, 17
                for length, c in enumerate(counts, 1):
                    for _ in range(c):
                        codes[length, code] = body[n]
                        code, n = code + 1, n + 1
                    code <<= 1
                t["h"][body[0]] = codes
                body = body[n:]
        elif marker == 0xDD:
            t["restart"] = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            t["scan"] = [(body[1 + 2 * i], body[2 + 2 * i]) for i in range(body[0])]
        at += 2 + size
    return t


def _split(jpeg: bytes) -> tuple[bytes, bytes]:
    """Header through the start of scan, and entropy-coded data."""
    at = 2
    while jpeg[at + 1] != 0xDA:
        at += 2 + struct.unpack_from(">H", jpeg, at + 2)[0]
    at += 2 + struct.unpack_from(">H", jpeg, at + 2)[0]
    return jpeg[:at], jpeg[at : jpeg.rindex(b"\xff\xd9")]


def _decode_bits(data: bytes, t: dict) -> np.ndarray:
    """Coefficients of any baseline scan: blocks in scan order, zigzag order inside."""
    parts = {c: (s >> 4, s & 15) for c, s, _ in t["parts"]}
    order = [(c, k) for c, k in t["scan"] for _ in range(parts[c][0] * parts[c][1] if len(t["scan"]) > 1 else 1)]
    hmax, vmax = max(p[0] for p in parts.values()), max(p[1] for p in parts.values())
    (height, width), alone = t["size"], len(t["scan"]) == 1
    units = -(-width // (8 * (1 if alone else hmax))) * -(-height // (8 * (1 if alone else vmax)))
    segments = re.split(rb"\xff[\xd0-\xd7]", data) if t["restart"] else [data]
    blocks = []
    for seg in segments:
        seg = seg.replace(b"\xff\x00", b"\xff")
        bits, left, at = int.from_bytes(seg, "big"), 8 * len(seg), 0
        dc: dict[int, int] = {}

        def take(n):
            nonlocal at
            at += n
            return bits >> left - at & (1 << n) - 1 if at <= left else (bits << at - left) & (1 << n) - 1 | (1 << min(n, at - left)) - 1

        def symbol(table):
            code = 0
            for length in range(1, 17):
                code = code << 1 | take(1)
                if (length, code) in table:
                    return table[length, code]
            raise ValueError("bad Huffman code")

        def value(n):
            v = take(n)
            return v if n == 0 or v >> n - 1 else v - (1 << n) + 1

        for _ in range(min(t["restart"] or units, units - len(blocks) // len(order))):
            for c, k in order:
                b = [0] * 64
                dc[c] = b[0] = dc.get(c, 0) + value(symbol(t["h"][k >> 4]))
                i = 1
                while i < 64:
                    run, n = divmod(symbol(t["h"][0x10 | k & 15]), 16)
                    if not n and run < 15:
                        break
                    i += run
                    b[i], i = value(n), i + 1
                blocks.append(b)
    return np.array(blocks, np.int32).reshape(-1, 64)


def decode_frame(jpeg: bytes) -> tuple[np.ndarray, dict]:
    """(coefficients (blocks, 64) in scan and zigzag order, header)."""
    head, data = _split(jpeg)
    t = _tables(head)
    n = (len(data) + 2) // (2 * UNIT + 2)
    if head == _jpeg_head(n) and len(data) == n * (2 * UNIT + 2) - 2:
        b = np.frombuffer(data + b"\xff\xd0", np.uint8).reshape(n, -1)
        if not b[:, : 2 * UNIT : 2].any():
            v = b[:, 1 : 2 * UNIT : 2].astype(np.int32)
            return np.where(v < 128, v - 255, v).reshape(-1, 64), t
    return _decode_bits(data, t), t


def coefficient_bytes(coefficients: np.ndarray) -> bytes:
    return np.where(coefficients < 0, coefficients + 255, coefficients).astype(np.uint8).tobytes()


def luma(coefficients: np.ndarray, t: dict) -> np.ndarray:
    """8-bit samples (blocks, 64) of the first component's blocks."""
    first, area = t["scan"][0][0], {c: (s >> 4) * (s & 15) for c, s, _ in t["parts"]}
    per = sum(area[c] for c, _ in t["scan"]) if len(t["scan"]) > 1 else 1
    own = area[first] if per > 1 else 1
    z = coefficients.reshape(-1, per, 64)[:, :own].reshape(-1, 64)
    q = t["q"][next(q for c, _, q in t["parts"] if c == first)]
    square = np.empty(z.shape, np.float32)
    square[:, ZIGZAG] = z * q
    return np.clip(np.rint(DCT.T @ square.reshape(-1, 8, 8) @ DCT) + 128, 0, 255).astype(np.uint8).reshape(-1, 64)


def shots(samples: np.ndarray, fps: float, bins: int = 16, window: int = 8, factor: float = 2.5, least: float = 0.2) -> list[tuple]:
    """Clips (first_frame, frames, start_s, end_s, peak) of frames (n, samples).

    A clip begins where the histogram difference (half the L1 distance, 0 to 1)
    is at least ``least`` and over the mean of the ``window`` differences before
    by ``factor`` standard deviations; before the first one both are 0.  A cut is
    left out of that window, so that it hides no later one, unless the frame
    before began a clip too.  ``peak``: the difference at its start.
    """
    n, size = samples.shape
    hist = np.bincount(((samples >> 4).astype(np.int64) + bins * np.arange(n)[:, None]).ravel(), minlength=bins * n).reshape(n, bins) / size
    diff = np.abs(np.diff(hist, axis=0)).sum(axis=1) / 2
    cuts, held, last = [0], deque(maxlen=window), False
    for i, d in enumerate(diff.tolist()):
        cut = False
        if d >= least:
            mean = sum(held) / max(1, len(held))
            cut = d > mean + factor * math.sqrt(sum((x - mean) ** 2 for x in held) / max(1, len(held)))
        if cut:
            cuts.append(i + 1)
        if not cut or last:
            held.append(d)
        last = cut
    return [(a, b - a, a / fps, b / fps, round(float(diff[a - 1]), 6) if a else 0.0) for a, b in zip(cuts, [*cuts[1:], n])]


def clips_of(media: bytes) -> tuple[bytes, list[tuple]]:
    """(payload, clips) of an AVI file written by ``write_avi``, or (all
    coefficient bytes, clips) of another baseline one."""
    fps, frames, noted = read_avi(media)
    decoded = [decode_frame(f) for f in frames]
    payload = b"".join(coefficient_bytes(c) for c, _ in decoded)
    small = [c.reshape(-1) for c, _ in decoded]
    if small and all(len(x) == len(small[0]) for x in small):
        y = luma(np.concatenate([c for c, _ in decoded]), decoded[0][1]).reshape(len(small), -1)
    else:
        y = np.zeros((len(small), 1), np.uint8)
    return payload[:noted], shots(y, fps) if len(y) else []


def to_payload(text: str | None) -> tuple[int, bytes]:
    """(UTF-8 bytes, those bytes filled with spaces to a positive multiple of 192)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw.ljust(max(1, -(-len(raw) // UNIT)) * UNIT)


def with_media(rows: DataFrame, text: str = "text", out: str = "media") -> DataFrame:
    """Adds ``out``, the text stored as an AVI file.  Null text: like empty."""

    @F.pandas_udf("binary")
    def store(texts: pd.Series) -> pd.Series:
        return pd.Series([write_avi(to_payload(t)[1]) for t in texts], dtype=object)

    return rows.withColumn(out, store(F.col(text)))


def with_clips(rows: DataFrame, media: str = "media", out: str = "clips") -> DataFrame:
    """Adds ``out`` (array of timed clips) and ``payload`` (the bytes read back).
    Null media: nulls."""

    @F.pandas_udf(f"payload binary, clips {SHOT}")
    def read(files: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, None) if f is None else clips_of(bytes(f)) for f in files], columns=["payload", "clips"])

    found = rows.withColumn("__read", read(F.col(media)))
    return found.select(*rows.columns, F.col("__read.payload").alias("payload"), F.col("__read.clips").alias(out))


def clip_rows(rows: DataFrame, key: str, clips: str = "clips") -> DataFrame:
    """One row per timed clip: key, clip, first_frame, frames, start_s, end_s, peak."""
    return rows.select(key, F.posexplode(clips).alias("clip", "c")).select(key, "clip", "c.*")


def media_digests(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The digests of each text's stored and reread media, in one pass: key,
    n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, clips.  Neither media nor payload leaves the worker."""
    schema = f"n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, clips {SHOT}"

    def digest(text):
        n, sent = to_payload(text)
        media = write_avi(sent)
        payload, clips = clips_of(media)
        return n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), clips

    @F.pandas_udf(schema)
    def digests(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([digest(t) for t in texts], columns=[c.split()[0] for c in schema.split(", ")[:6]] + ["clips"])

    return rows.select(F.col(key), digests(F.col(text)).alias("d")).select(key, "d.*")
