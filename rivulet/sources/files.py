"""Files as texts: plain text, Markdown, DOCX and simple PDF."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections import Counter
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
REPEATED, LEAST = 0.3, 2  # share of the pages, and pages at least, on which a first or last line is boilerplate


def docx_text(data: bytes) -> str:
    """Paragraphs by line; headings as Markdown; table rows by cell."""
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml")).find(f"{W}body")
    said = lambda p: "".join({f"{W}t": x.text or "", f"{W}tab": "\t", f"{W}br": "\n"}.get(x.tag, "") for x in p.iter())
    out = []
    for e in body:
        if e.tag == f"{W}p":
            style = e.find(f"{W}pPr/{W}pStyle")
            level = re.fullmatch(r"[Hh]eading(\d)", style.get(f"{W}val", "")) if style is not None else None
            out.append(("#" * int(level[1]) + " " if level else "") + said(e))
        elif e.tag == f"{W}tbl":
            out += [" | ".join(said(c).strip() for c in r.iter(f"{W}tc")) for r in e.iter(f"{W}tr")]
    return "\n\n".join(x for x in (p.strip() for p in out) if x)


_TOKEN = re.compile(rb"\((?:[^()\\]|\\.)*\)|<[0-9A-Fa-f\s]*>|\[|\]|[^\s\[\]()<>]+", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _literal(token: bytes) -> str:
    if token[:1] == b"<":
        raw = bytes.fromhex(re.sub(rb"\s", b"", token[1:-1]).decode().ljust(len(token) & ~1, "0")[: 2 * ((len(token) - 1) // 2)])
    else:
        raw = re.sub(rb"\\([0-7]{1,3}|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1].isdigit() else _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.S)
    return raw.decode("utf-16-be", "ignore") if raw[:2] == b"\xfe\xff" else raw.decode("latin-1")


def pdf_pages(data: bytes) -> list[str]:
    """The text drawn by each content stream: plain or deflated streams of
    single-byte fonts, a line a text position.  Other encodings give nothing."""
    pages = []
    for m in re.finditer(rb"<<(.*?)>>\s*stream\r?\n(.*?)\r?\nendstream", data, re.S):
        raw = m[2]
        if b"/FlateDecode" in m[1]:
            try:
                raw = zlib.decompressobj().decompress(raw)
            except zlib.error:
                continue
        if b"BT" not in raw:
            continue
        lines, stack = [""], []
        for t in _TOKEN.findall(raw):
            if t[:1] in b"(<":
                stack.append(_literal(t))
            elif t in (b"Tj", b"TJ"):
                lines[-1] += "".join(x for x in stack if isinstance(x, str))
                stack = []
            elif t in (b"'", b'"'):
                lines.append("".join(x for x in stack if isinstance(x, str)))
                stack = []
            elif t in (b"Td", b"TD", b"T*", b"Tm", b"ET"):
                lines.append("")
                stack = []
        pages.append("\n".join(x.strip() for x in lines if x.strip()))
    return [p for p in pages if p]


def joined_pages(pages: list[str]) -> str:
    """Pages without the first and last lines that many share, words parted at a
    line end made whole again."""
    split = [p.split("\n") for p in pages]
    edges = Counter(x for p in split for x in {re.sub(r"\d+", "#", p[0]), re.sub(r"\d+", "#", p[-1])})
    bound = max(LEAST, REPEATED * len(pages))
    kept = [[x for i, x in enumerate(p) if not (i in (0, len(p) - 1) and len(pages) > 1 and edges[re.sub(r"\d+", "#", x)] >= bound)] for p in split]
    return re.sub(r"(?<=[a-z])-\n(?=[a-z])", "", "\n\n".join("\n".join(p) for p in kept if p))


def text_of(name: str, data: bytes) -> str:
    """By the name's ending; other files must be UTF-8 text."""
    kind = name.rsplit(".", 1)[-1].lower()
    if kind == "doc":
        raise ValueError("old Word files are not supported")
    if kind == "docx":
        return docx_text(data)
    if kind == "pdf":
        if not data.startswith(b"%PDF"):
            raise ValueError("not a PDF file")
        return joined_pages(pdf_pages(data))
    if b"\0" in data[:8192]:
        raise ValueError("not a text file")
    return data.decode("utf-8-sig")


def read_texts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name, text and error (null where the text is read) of files, one row
    each; a file that cannot be read stops nothing."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)

    @F.pandas_udf("text string, error string")
    def read(names: pd.Series, contents: pd.Series) -> pd.DataFrame:
        out = []
        for n, c in zip(names, contents):
            try:
                out.append((text_of(n, bytes(c)), None))
            except (ValueError, KeyError, zipfile.BadZipFile, ElementTree.ParseError) as e:
                out.append((None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(out, columns=["text", "error"])

    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("name"), read(name, F.col("content")).alias("r")).select("path", "name", "r.*")
