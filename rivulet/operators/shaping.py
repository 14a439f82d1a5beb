"""Row shaping: wildcard field selection, masking, log lines, templates, XML."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.core import ws_trim

MASK = "***"


def _glob(patterns: list[str]) -> str:
    return "^(?:" + "|".join(".*".join(map(re.escape, p.split("*"))) for p in patterns) + ")$"


def select_fields(m: Column, include: list[str] = (), exclude: list[str] = (), keep: list[str] = ()) -> Column:
    """Map entries by name: included ones (all if none are named) and ``keep``,
    less excluded ones.  ``*`` stands for any text."""
    if include:
        m = F.map_filter(m, lambda k, _: k.rlike(_glob([*include, *keep])))
    return F.map_filter(m, lambda k, _: ~k.rlike(_glob(list(exclude)))) if exclude else m


def mask_fields(m: Column, names: list[str], partial: bool = False) -> Column:
    """Values of sensitive fields (by ``*`` pattern, any case) as ``***``, or
    their first characters, at most three, and ``***``."""
    hit = "(?i)" + _glob(names)
    shown = (lambda v: F.when(F.length(v) <= 3, F.lit(MASK)).otherwise(F.concat(F.left(v, F.lit(3)), F.lit(MASK)))) if partial else (lambda v: F.lit(MASK))
    return F.transform_values(m, lambda k, v: F.when(k.rlike(hit) & v.isNotNull(), shown(v)).otherwise(v))


def _sorted_entries(m: Column) -> Column:
    return F.array_sort(F.map_entries(m))


def key_value(m: Column) -> Column:
    """``k=v`` in key order; values with a space or tab are quoted."""
    def item(e):
        v = F.coalesce(e.value, F.lit(""))
        return F.concat(e.key, F.lit("="), F.when(v.rlike(r"[ \t]"), F.concat(F.lit('"'), v, F.lit('"'))).otherwise(v))

    return F.array_join(F.transform(_sorted_entries(m), item), " ")


def logfmt(m: Column) -> Column:
    """As ``key_value``; empty values and those with white space, quotes or
    backslashes are quoted and escaped."""
    def item(e):
        v = F.coalesce(e.value, F.lit(""))
        escaped = F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
        return F.concat(e.key, F.lit("="), F.when((v == "") | v.rlike(r'[\s"\\]'), F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(v))

    return F.array_join(F.transform(_sorted_entries(m), item), " ")


def json_line(m: Column) -> Column:
    return F.to_json(F.map_from_entries(_sorted_entries(m)))


def ecs(m: Column, service: str, host: str) -> Column:
    """Adds service and host fields that are absent."""
    more = F.create_map(F.lit("service.name"), F.lit(service), F.lit("host.name"), F.lit(host))
    return F.map_concat(F.map_filter(more, lambda k, _: ~F.map_contains_key(m, k)), m)


def _title(s: Column) -> Column:
    return F.array_join(F.transform(F.split(s, " ", -1), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, F.lit(2), F.length(w)))), " ")


def _ordered(a: Column, b: Column, numbers: bool) -> tuple[Column, Column]:
    return (a.try_cast("long"), b.try_cast("long")) if numbers else (a.cast("string"), b.cast("string"))


# Parts of a reference-date layout and of a date pattern.
LAYOUT = [("2006", "yyyy"), ("January", "MMMM"), ("Jan", "MMM"), ("01", "MM"), ("02", "dd"), ("15", "HH"), ("04", "mm"), ("05", "ss"), ("Monday", "EEEE"), ("Mon", "EEE"), ("PM", "a"), ("03", "hh"), ("Z07:00", "XXX"), ("MST", "zzz")]


def date_pattern(layout: str) -> str:
    parts = re.split("(" + "|".join(re.escape(a) for a, _ in LAYOUT) + ")", layout)
    known = dict(LAYOUT)
    return "".join(known[p] if p in known else "".join(f"'{c}'" if c.isalpha() else c for c in p) for p in parts)


@dataclass(frozen=True)
class Value:
    """A template value: a column, whether it is an array, and its literal if it is one."""

    column: Column
    array: bool = False
    literal: object = None

    @property
    def text(self) -> Column:
        return F.array_join(self.column, " ") if self.array else self.column.cast("string")

    @property
    def whole(self) -> Column:
        return F.coalesce(self.column.try_cast("long"), F.lit(0))


def _plain(f):
    return lambda *a: Value(f(*(x.text for x in a)))


def _compare(test):
    def run(a: Value, b: Value) -> Value:
        numbers = any(isinstance(x.literal, int) for x in (a, b))
        return Value(test(*_ordered(a.column, b.column, numbers)))

    return run


TEMPLATE_FUNCTIONS = {
    "upper": _plain(F.upper), "lower": _plain(F.lower), "trim": _plain(ws_trim), "reverse": _plain(F.reverse), "title": _plain(_title),
    "capitalize": _plain(lambda s: F.concat(F.upper(F.left(s, F.lit(1))), F.lower(F.substring(s, F.lit(2), F.length(s))))),
    "truncate": lambda n, s: Value(F.when(F.octet_length(s.text) <= n.literal, s.text).otherwise(F.concat(F.left(s.text, F.lit(n.literal)), F.lit("...")))),
    "replace": _plain(lambda old, new, s: F.replace(s, old, new)), "contains": _plain(lambda s, part: F.contains(s, part)),
    "add": lambda a, b: Value(a.whole + b.whole), "subtract": lambda a, b: Value(a.whole - b.whole), "multiply": lambda a, b: Value(a.whole * b.whole),
    "divide": lambda a, b: Value(F.when(b.whole == 0, F.lit(0).cast("long")).otherwise(F.call_function("div", a.whole, F.nullif(b.whole, F.lit(0).cast("long"))))),
    "first": lambda a: Value(F.try_element_at(a.column, F.lit(1))), "last": lambda a: Value(F.try_element_at(a.column, F.lit(-1))),
    "length": lambda a: Value(F.size(a.column) if a.array else F.octet_length(a.text)),
    "sort": lambda a: Value(F.array_sort(a.column), True), "join": lambda a, sep: Value(F.array_join(a.column, sep.literal)),
    "split": lambda s, sep: Value(F.split(s.text, "" if sep.literal == "" else re.escape(sep.literal), -1), True),
    "eq": _compare(lambda a, b: a.eqNullSafe(b)), "ne": _compare(lambda a, b: ~a.eqNullSafe(b)),
    "lt": _compare(lambda a, b: a < b), "gt": _compare(lambda a, b: a > b), "le": _compare(lambda a, b: a <= b), "ge": _compare(lambda a, b: a >= b),
    "default": lambda d, v: Value(F.coalesce(F.nullif(v.text, F.lit("")), d.text)),
    "json": lambda v: Value(F.to_json(v.column) if v.array else F.regexp_replace(F.to_json(F.array(v.column)), r"(?s)^\[(.*)\]$", "$1")),
    "formatDate": lambda layout, d: Value(F.coalesce(F.date_format(d.text.try_cast("timestamp"), date_pattern(layout.literal)), F.lit(""))),
    "now": lambda: Value(F.current_timestamp()),
}


def render(template: str, fields: dict[str, Column], arrays: tuple[str, ...] = (), escape: bool = False) -> Column:
    """``{{name}}``, ``{{.name}}`` and calls ``{{function arg ...}}``, piped by
    ``|`` as the last argument, filled in; arguments are fields, "texts" and whole
    numbers.  ``arrays`` names the fields that are arrays.  An unknown name is
    empty; ``escape`` makes HTML characters entities."""
    def atom(word: str) -> Value:
        if word[0] == '"':
            return Value(F.lit(json.loads(word)), literal=json.loads(word))
        if re.fullmatch(r"-?\d+", word):
            return Value(F.lit(int(word)), literal=int(word))
        name = word.removeprefix(".")
        return Value(fields.get(name, F.lit("")), name in arrays)

    def call(expression: str) -> Value:
        value = None
        for step in re.findall(r'(?:"(?:[^"\\]|\\.)*"|[^|"])+', expression):
            words = re.findall(r'"(?:[^"\\]|\\.)*"|\S+', step)
            args = [value] if value is not None else []
            if words[0] in TEMPLATE_FUNCTIONS and words[0] not in fields:
                value = TEMPLATE_FUNCTIONS[words[0]](*map(atom, words[1:]), *args)
            else:
                value = atom(words[0])
        return value

    parts = re.split(r"\{\{\s*(.*?)\s*\}\}", template)
    out = [F.lit(parts[0])]
    for i in range(1, len(parts), 2):
        shown = F.coalesce(call(parts[i]).text, F.lit(""))
        if escape:
            for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;"), ("'", "&#39;")):
                shown = F.replace(shown, F.lit(a), F.lit(b))
        out += [shown, F.lit(parts[i + 1])]
    return F.concat(*out)


def flatten(df: DataFrame, prefix: str = "") -> Column:
    """All columns as one map of texts: structs by dotted names, arrays and maps
    of other values as JSON; null values stay null."""
    entries = []

    def walk(c: Column, kind: T.DataType, name: str):
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(c.getField(f.name), f.dataType, f"{name}.{f.name}" if name else f.name)
        else:
            entries.extend([F.lit(name), F.to_json(c) if isinstance(kind, (T.ArrayType, T.MapType)) else c.cast("string")])

    for f in df.schema.fields:
        walk(F.col(f"`{f.name}`"), f.dataType, f"{prefix}.{f.name}" if prefix else f.name)
    return F.create_map(*entries)


def sse_event(data: Column, event: Column | None = None, event_id: Column | None = None, retry_ms: int = 0) -> Column:
    """One server-sent event as text: id, event (unless ``message``), retry, data."""
    none = F.lit(None).cast("string")
    line = lambda name, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{name}: "), c, F.lit("\n"))).otherwise("")
    kind = none if event is None else F.nullif(event, F.lit("message"))
    return F.concat(line("id", none if event_id is None else event_id.cast("string")), line("event", kind), F.lit(f"retry: {retry_ms}\n" if retry_ms > 0 else ""), F.lit("data: "), F.coalesce(data, F.lit("")), F.lit("\n\n"))


def content_type(text: Column) -> Column:
    """A guess by what a text begins with, ends with and holds."""
    t = ws_trim(text)
    bounds = lambda a, b: F.startswith(t, F.lit(a)) & F.endswith(t, F.lit(b))
    is_json = (bounds("{", "}") | bounds("[", "]")) & F.try_parse_json(t).isNotNull()
    has = lambda *parts: reduce(lambda a, b: a | b, [F.contains(t, F.lit(p)) for p in parts])
    return (
        F.when(is_json, "application/json").when(F.startswith(t, F.lit("<?xml")) | bounds("<", ">"), "application/xml").when(has("<html>", "<!DOCTYPE"), "text/html")
        .when(has("Subject:"), "message/rfc822").when(has("# ", "## ", "- ", "* "), "text/markdown").otherwise("text/plain")
    )


def used_variables(template: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(template, F.lit(r"\{\{\s*\.?(\w+)\s*\}\}"), F.lit(1)))


def xml_filter(xml: Column, paths: list[str], mode: str = "and") -> Column:
    """The XML if all (any) XPaths match a node, else "" ; empty input: ""."""
    hits = [F.coalesce(F.xpath_boolean(xml, F.lit(f"boolean({p})")), F.lit(False)) for p in paths]
    ok = F.lit(bool(paths))
    for i, h in enumerate(hits):
        ok = h if not i else (ok & h if mode == "and" else ok | h)
    return F.when(F.coalesce(F.trim(xml), F.lit("")) == "", "").when(ok, xml).otherwise("")


def content_flags(text: Column) -> Column:
    """struct of line-based traits of a text, its kind and its complexity class."""
    rows = F.transform(F.split(text, "\n", -1), ws_trim)
    has = lambda p: F.exists(rows, lambda x: x.rlike(p))
    sections = F.filter(rows, lambda x: F.endswith(x, F.lit(":")) & (F.octet_length(x) > 1))
    traits = {"subject": has(r"^Subject:"), "greeting": has(r"(?i)hello|dear|hi "), "signature": has(r"(?i)sincerely|best regards|thank you"), "bullets": has(r"^[\u2022*]\s"), "numbered": has(r"^\d+\.\s")}
    lists = traits["bullets"] | traits["numbered"]
    score = sum(traits[k].cast("int") for k in ("subject", "greeting", "signature")) + F.when(lists, 2).otherwise(0) + F.size(sections) + (F.size(rows) > 10).cast("int") + (F.size(rows) > 20).cast("int")
    level = F.when(score <= 2, "simple").when(score <= 5, "moderate").when(score <= 8, "complex").otherwise("highly-complex")
    kind = F.when(traits["subject"], "email").when(lists, "document-with-lists").when(F.size(sections) > 0, "structured-document").otherwise("plain-text")
    return F.struct(*[c.alias(k) for k, c in traits.items()], F.size(sections).alias("sections"), F.size(F.filter(rows, lambda x: x == "")).alias("empty_lines"), score.alias("score"), kind.alias("kind"), level.alias("complexity"))
