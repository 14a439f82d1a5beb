"""Text clean-up and unstructured-element parsing."""

from __future__ import annotations

import html
import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import ws_trim
from .scalar import scalar

# What the clean-up looks for.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
NUMERIC_ENTITY = r"&#[xX]?[0-9a-fA-F]+;"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]"
IMAGE = r"\[image:[^\]]*\]"
EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+(?:\.[a-zA-Z]{2,})?"
URL_LINE = r"(?md)^(?:(?:https?|ftp)://|mailto:)\S*[\t\n\f\r ]*$"
URL_FRAGMENT = r"(?md)^(?:(?:com|net|org|io|tools|api|gov|edu|de|uk|fr|nl)/\S*|/(?:display|pages|browse|projects|repos|spaces|wiki)[^\n]*|\.[a-z]{2,6}|com|io)[\t\n\f\r ]*$"
SHORT = 20  # bytes of a fragment that joins its neighbour over one blank line


def join_fragments(s: Column) -> Column:
    """A short line, one blank line and a short line become one line; the pair
    is done with.  Lengths are bytes, so bytes stand as characters meanwhile."""
    raw = F.decode(F.encode(s, "UTF-8"), "ISO-8859-1")
    one = rf"(?md)^([^\n]{{1,{SHORT}}})\n\n([^\n]{{1,{SHORT}}})$"
    return F.decode(F.encode(F.regexp_replace(raw, one, "$1 $2"), "ISO-8859-1"), "UTF-8")


@scalar("text.cleanText")
def clean_text(s: Column) -> Column:
    """Entities, control characters, image marks, e-mail addresses and link
    lines go; short fragments join; blank lines shrink.  Null stays null."""
    # one pass over named entities: a mark keeps decoded ampersands from being read again
    for name, char in ENTITIES:
        s = F.replace(s, F.lit(name), F.lit("\x01" if char == "&" else char))
    s = F.replace(s, F.lit("\x01"), F.lit("&"))
    for pattern, by in ((NUMERIC_ENTITY, ""), (CONTROL, ""), (IMAGE, ""), (EMAIL, "[email]"), (URL_LINE, ""), (URL_FRAGMENT, "")):
        s = F.regexp_replace(s, pattern, by)
    s = F.array_join(F.transform(F.split(s, "\n", -1), ws_trim), "\n")

    return ws_trim(F.regexp_replace(join_fragments(s), r"\n{3,}", "\n\n"))


class _Table(HTMLParser):
    def __init__(self):
        super().__init__()
        self.rows: list[list[str]] = []
        self.cell = None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            self.cell = []

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            if not self.rows:
                self.rows.append([])
            self.rows[-1].append(re.sub(r"\s+", " ", "".join(self.cell)).strip())
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(html.unescape(data))


SKIPPED = ("Footer", "Header", "PageBreak", "Image")


def parse_elements(text: str | None) -> str | None:
    """Elements of a JSON list as text: tables as ``header: value`` rows."""
    if text is None:
        return None
    parts = []
    for e in json.loads(text or "[]"):
        if e.get("type") in SKIPPED:
            continue
        body = (e.get("text") or "").strip()
        if e.get("type") == "Table" and (source := (e.get("metadata") or {}).get("text_as_html")):
            t = _Table()
            t.feed(source)
            rows = [r for r in t.rows if any(r)]
            if len(rows) > 1:
                body = "\n".join(" | ".join(f"{h}: {v}" if h else v for h, v in zip(rows[0], r) if v) for r in rows[1:])
        if body:
            parts.append(body)
    return "\n\n".join(parts)


@scalar("text.parseUnstructured")
def parse_unstructured(s: Column) -> Column:
    @F.pandas_udf("string")
    def parsed(texts: pd.Series) -> pd.Series:
        return texts.map(parse_elements)

    return parsed(s)


# Sizes, words and patterns of section chunks.
PROSE, HARD_CAP, CELL, DIGEST_CELL = 1500, 6000, 200, 400
DESCRIPTION = re.compile(r"(?i)^\s*(description|comments?|notes?|guidance|details|remarks?|example|explanation|definition|instructions?|help)\s*$")
GUIDANCE = re.compile(r"(?i)\b(please|describe|optional|provide an?|should|must|e\.?g\.?|i\.?e\.?|for example|list them|add details|fill in|enter the|specify)\b", re.ASCII)
TIER = re.compile(r"(?i)^\s*(dev(elopment)?|sit|uat|prd|prod(uction)?|qa|ga|stg|staging|pre|preprod|test|integration)\s*$")
PLACEHOLDERS = ("", "-", "n/a", "na")


class _Grid(HTMLParser):
    """The last head row, and the rows of the body (all rows if none is marked)."""

    def __init__(self, source: str):
        super().__init__()
        self.part, self.head, self.body, self.loose, self.row, self.cell = "", [], [], [], None, None
        self.feed(source)
        self.headers = next((r for r in reversed(self.head) if r), [])
        self.rows = [r for r in (self.body if self.body else self.head + self.loose) if r]

    def handle_starttag(self, tag, attrs):
        if tag in ("thead", "tbody"):
            self.part = tag
        elif tag == "tr":
            self.row = []
            {"thead": self.head, "tbody": self.body}.get(self.part, self.loose).append(self.row)
        elif tag in ("td", "th") and self.row is not None:
            self.cell = []

    def handle_endtag(self, tag):
        if tag in ("thead", "tbody"):
            self.part = ""
        elif tag in ("td", "th") and self.cell is not None:
            self.row.append(re.sub(r"\s+", " ", "".join(self.cell)).strip())
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(html.unescape(data))


def _cut(s: str, size: int) -> str:
    return s if len(s) <= size else s[:size] + "\u2026"


def _size(s: str) -> int:
    return len(s.encode())


def _capped(s: str) -> str:
    return s if _size(s) <= HARD_CAP else s.encode()[:HARD_CAP].decode(errors="ignore")


def _is_guidance(header: str, cells: list[str]) -> bool:
    """A column of instructions: by its name, or by long cells that read so."""
    if DESCRIPTION.match(header):
        return True
    said = [c for c in cells if c]
    if len(cells) < 3 or not said:
        return False
    return sum(map(_size, said)) // len(said) > 80 and 5 * sum(bool(GUIDANCE.search(c)) for c in said) >= 2 * len(said)


def _table_chunks(prefix: str, source: str) -> tuple[list[str], bool]:
    """(chunks, whether the table had rows)."""
    grid = _Grid(source)
    headers, rows = grid.headers, grid.rows
    keep = [i for i in range(max([len(headers), *map(len, rows)], default=0)) if i >= len(headers) or not _is_guidance(headers[i], [r[i] if i < len(r) else "" for r in rows])]
    headers, rows = [headers[i] for i in keep if i < len(headers)], [[r[i] for i in keep if i < len(r)] for r in rows]
    top = [prefix] if prefix else []
    if len(headers) >= 3 and sum(bool(TIER.match(h)) for h in headers[1:]) >= 2:  # one chunk a property and tier
        cells = [(r[0], h.strip().upper(), v) for r in rows if len(r) > 1 and r[0] for h, v in zip(headers[1:], r[1:]) if TIER.match(h) and v.lower() not in PLACEHOLDERS]
        return ["\n".join([*top, f"{name} ({tier}): {_cut(v, CELL)}"]) for name, tier, v in cells], True
    out = []
    if rows and 4 * sum(len(r) == 2 for r in rows) >= 3 * len(rows):
        fields = [f"- {r[0]}: {_cut(r[1], DIGEST_CELL)}" for r in rows if len(r) > 1 and r[0] and r[1]]
        if len(top) + 1 + len(fields) > 2:
            out.append(_capped("\n".join([*top, "Form fields:", *fields])))
    shown = [" | ".join(f"{headers[i]}: {_cut(c, CELL)}" if i < len(headers) and headers[i] else _cut(c, CELL) for i, c in enumerate(r) if c) for r in rows]
    columns = " | ".join(headers)
    names, held, size = ["Table:"], [], 0

    def flush():
        out.append("\n".join([*top, names[-1], *([f"Columns: {columns}"] if columns else []), *held]))

    for line in (x for x in shown if x):
        more = _size(line) + 1 + (_size(prefix) + _size(columns) + 32 if len(names) > 1 else 0)
        if held and size + more > HARD_CAP:
            flush()
            names.append("Table (continued):")
            held, size = [], 0
        size += _size(line) + bool(held)
        held.append(line)
    if held:
        flush()
    return out, bool(rows)


def smart_chunks(elements: str | None, name: str | None = "") -> str | None:
    """Elements of a JSON list as chunks parted by blank lines, each under its
    document and section: prose gathered to ``PROSE`` bytes, tables by rows,
    by fields, or by property and environment.  Repeated chunks go."""
    if elements is None:
        return None
    title = re.sub(r"(?<!^)\.[^./]*$", "", (name or "").rstrip("/").rsplit("/", 1)[-1]).strip()
    document = f"[Document: {title}]" if title else ""
    out, section, prose = [], "", []

    def header() -> str:
        return " ".join(x for x in (document, f"[Section: {section}]" if section else "") if x)

    def put(top: str, body: str):
        if body := body.strip():
            out.append(f"{top}\n{body}" if top else body)

    def flush():
        put(header(), "\n".join(prose))
        prose.clear()

    for e in json.loads(elements) if elements.strip() else []:
        kind, text = e.get("type") or "", (e.get("text") or "").strip()
        if kind in SKIPPED:
            continue
        if kind == "Title":
            flush()
            section = text or section
            put(document, f"Section heading: {text}" if text else "")
        elif kind == "Table":
            flush()
            source = (e.get("metadata") or {}).get("text_as_html")
            chunks, had_rows = _table_chunks(header(), source) if isinstance(source, str) and source else ([], False)
            out += chunks
            if not had_rows and text:
                put(header(), _capped(f"Table:\n{text}"))
        else:
            text = f"\u2022 {text}" if kind == "ListItem" else text
            if prose and _size("\n".join(prose)) + _size(text) + 1 > PROSE:
                flush()
            prose.extend([text] if text else [])
    flush()
    first: dict[str, str] = {}
    for c in out:
        first.setdefault(c.strip(), c)
    return "\n\n".join(c for k, c in first.items() if k)


@scalar("text.smartChunk")
def smart_chunk(s: Column, name: Column | str = "") -> Column:
    """Needs an HTML parser, so Python; one call a text."""
    @F.pandas_udf("string")
    def chunked(texts: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([smart_chunks(t, n) for t, n in zip(texts, names)], dtype=object)

    return chunked(s, name if isinstance(name, Column) else F.lit(name))
