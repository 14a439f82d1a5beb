"""Declarative rules over semi-structured documents, compiled to columns.

A rule has an id, a severity, a message and a match condition, and may have a
scope (a JSON path to an array, exploded), a ``when`` pre-condition and tags.
Conditions resolve a dot path in a JSON item (``$``-style), a map, or the item itself.
"""

from __future__ import annotations

import re
from functools import reduce
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import num

SEVERITIES = ("ERROR", "WARNING", "INFO", "GOOD")
ALIASES = {"not_empty": "exists", "not_missing": "exists", "regex_match": "regex", "count_greater_than": "count_exceeds"}


def load_rules(folder: str) -> tuple[list[dict], list[str]]:
    """Rules of all .yaml files below a driver-side folder, in path order; the
    first of an id wins.  (rules, warnings)"""
    import yaml

    rules, warnings, seen = [], [], set()
    for p in sorted(Path(folder).rglob("*.yaml")):
        try:
            found = yaml.safe_load(p.read_text())
            for r in found if isinstance(found, list) else found.get("rules", [found]):
                validate(r)
                if r["id"] in seen:
                    warnings.append(f"{p}: duplicate id {r['id']}")
                    continue
                seen.add(r["id"])
                rules.append(r)
        except (ValueError, AttributeError, KeyError, TypeError, yaml.YAMLError) as e:
            warnings.append(f"{p}: {e}")
    return rules, warnings


def validate(rule: dict) -> None:
    if not rule.get("id") or rule.get("severity") not in SEVERITIES or not isinstance(rule.get("match"), dict):
        raise ValueError(f"bad rule {rule.get('id')!r}: needs id, severity and match")


def select_rules(rules: list[dict], disabled: list[str] = (), tags: list[str] = (), parser: str | None = None) -> list[dict]:
    kept = [r for r in rules if r["id"] not in disabled and (not tags or set(tags) & set(r.get("tags", ()))) and (not parser or r.get("parser", parser) == parser)]
    return sorted(kept, key=lambda r: (SEVERITIES.index(r["severity"]), r["id"]))


def value_at(item: Column, path: str | None) -> Column:
    return item if not path else F.get_json_object(item, "$." + path.removeprefix("$."))


def condition(item: Column, c: dict) -> Column:
    """Non-null boolean; null where a number is needed and absent (an error)."""
    kind = ALIASES.get(c["type"], c["type"])
    nested = lambda: [condition(item, x) for x in c.get("conditions", [])]
    if kind in ("any_of", "all_of", "none_of"):
        parts = nested()
        if not parts:
            return F.lit(False)
        either = reduce(lambda a, b: a | b, parts)
        return {"any_of": either, "all_of": reduce(lambda a, b: a & b, parts), "none_of": ~either}[kind]
    if kind == "all_missing":
        paths = c.get("paths", [])
        return reduce(lambda a, b: a & b, [_missing(value_at(item, p)) for p in paths]) if paths else F.lit(False)
    v = value_at(item, c.get("path"))
    want = "" if c.get("value") is None else str(c["value"]).lower() if isinstance(c.get("value"), bool) else str(c["value"])
    gone = v.isNull()
    if kind == "missing":
        return _missing(v)
    if kind == "exists":
        return ~_missing(v)
    if kind == "equals":
        return F.coalesce(v == want, F.lit(False))
    if kind == "not_equals":
        return F.coalesce(v != want, F.lit(True))
    if kind == "contains":
        return F.coalesce(F.contains(v, F.lit(want)), F.lit(False))
    if kind == "not_contains":
        return F.coalesce(~F.contains(v, F.lit(want)), F.lit(True))
    if kind == "contains_any":
        return F.coalesce(reduce(lambda a, b: a | b, [F.contains(v, F.lit(str(x))) for x in c["values"]], F.lit(False)), F.lit(False))
    if kind in ("regex", "regex_not_match"):
        pattern = (f"(?{c['flags']})" if c.get("flags") else "") + c["pattern"]
        if kind == "regex":
            return F.coalesce(v.rlike(pattern), F.lit(False))
        guard = F.contains(F.lower(v), F.lit(c["requires_contains"].lower())) if c.get("requires_contains") else F.lit(True)
        return F.coalesce(guard & ~v.rlike(pattern), F.lit(False))
    if kind in ("greater_than", "less_than"):
        return num(v) > float(c["value"]) if kind == "greater_than" else num(v) < float(c["value"])
    array = F.from_json(v, "array<string>")
    if kind == "count_exceeds":
        return F.coalesce(F.size(array) > int(c.get("min_count", c.get("value", 0))), F.lit(False))
    if kind == "none_contain":
        keys = [str(k).lower() for k in c.get("keys", c.get("values", []))]
        held = F.coalesce(F.transform(F.json_object_keys(v), lambda k: F.lower(k)), F.array().cast("array<string>"))
        inside = F.coalesce(F.exists(array, lambda e: reduce(lambda a, b: a | b, [F.contains(F.lower(e), F.lit(k)) for k in keys], F.lit(False))), F.lit(False))
        return F.when(gone, True).otherwise(~(F.arrays_overlap(held, F.array(*[F.lit(k) for k in keys])) | inside))
    if kind == "duplicate_values":
        least = max(2, int(c.get("min_count", 2)))
        return F.coalesce(F.exists(F.array_distinct(array), lambda x: F.size(F.filter(array, lambda y: y == x)) >= least), F.lit(False))
    if kind == "credential_header_literal":
        names = [str(h).lower() for h in c.get("headers", ["authorization"])]
        held = F.from_json(v, "map<string,string>")
        return F.coalesce(F.exists(F.map_entries(held), lambda e: F.lower(e.key).isin(names) & (F.trim(e.value) != "") & ~F.startswith(e.value, F.lit("=$"))), F.lit(False))
    raise ValueError(f"unsupported match type {c['type']!r}")


def _missing(v: Column) -> Column:
    return F.coalesce((v == "") | (v == "[]") | (v == "null"), F.lit(True))


def message(template: str, item: Column) -> Column:
    """``{{.a.b}}`` placeholders filled from the item."""
    parts = re.split(r"\{\{\s*\.(?:Scope\.)?([\w.]+)\s*\}\}", template)
    return F.concat(*[F.lit(p) if i % 2 == 0 else F.coalesce(value_at(item, p), F.lit("")) for i, p in enumerate(parts)])


def _judge(rule: dict):
    """item -> struct<rule_id, severity, message>, or null where the rule does not match."""

    def judge(item: Column) -> Column:
        ok = condition(item, rule["match"])
        if rule.get("when"):
            ok = F.when(condition(item, rule["when"]), ok).otherwise(False)
        said = F.struct(F.lit(rule["id"]).alias("rule_id"), F.lit(rule["severity"]).alias("severity"), message(rule.get("message", rule["id"]), item).alias("message"))
        failed = F.struct(F.lit(rule["id"]).alias("rule_id"), F.lit("INFO").alias("severity"), F.lit(f"rule {rule['id']} could not be evaluated").alias("message"))
        return F.when(ok.isNull(), failed).when(ok, said)

    return judge


def evaluate(docs: DataFrame, rules: list[dict], key: str, content: str) -> DataFrame:
    """Findings (key, rule_id, severity, message), one scan of the documents:
    all rules are one array of findings a row, exploded.  A condition that
    cannot be evaluated gives an INFO finding."""
    doc = F.col(content)
    found = []
    for r in select_rules(rules):
        validate(r)
        items = F.from_json(value_at(doc, r["scope"]), "array<string>") if r.get("scope") else F.array(doc)

        found.append(F.coalesce(F.filter(F.transform(items, _judge(r)), lambda x: x.isNotNull()), F.array()))
    return docs.select(F.col(key), F.explode(F.concat(*found)).alias("f")).select(key, "f.*")


def severity_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("severity").agg(F.count("*").alias("findings"))


def split_findings(findings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(problems, strengths): what GOOD rules found is a strength."""
    return findings.where("severity <> 'GOOD'"), findings.where("severity = 'GOOD'")


def rank(severity: str = "severity") -> Column:
    """Position of a severity, the gravest first."""
    return F.array_position(F.array(*[F.lit(x) for x in SEVERITIES]), F.col(severity))


def report(docs: DataFrame, findings: DataFrame, key: str) -> DataFrame:
    """A row a document: key, errors, warnings, infos and ``report``, Markdown with
    the findings by severity and rule, and the strengths.  Documents without
    findings have a report too."""
    cell = lambda c: F.replace(F.replace(F.replace(c, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit("")), F.lit("|"), F.lit("\\|"))
    n = lambda s: F.count(F.when(F.col("severity") == s, 1))
    one = F.struct(rank().alias("rank"), "rule_id", "message", "severity")
    each = findings.groupBy(key).agg(F.array_sort(F.collect_list(one)).alias("found"), n("ERROR").alias("errors"), n("WARNING").alias("warnings"), n("INFO").alias("infos"))
    rows = docs.select(key).join(each, key, "left").na.fill(0, ["errors", "warnings", "infos"]).withColumn("found", F.coalesce("found", F.array()))
    bad, good = F.filter("found", lambda f: f.severity != "GOOD"), F.filter("found", lambda f: f.severity == "GOOD")
    lines = F.transform(bad, lambda f: F.concat(F.lit("| "), f.severity, F.lit(" | "), f.rule_id, F.lit(" | "), cell(f.message), F.lit(" |\n")))
    strong = F.transform(good, lambda f: F.concat(F.lit("- **"), f.rule_id, F.lit("** \u2014 "), f.message, F.lit("\n")))
    head = F.format_string("## Analysis Report \u2014 %s\n\n**Errors:** %d  |  **Warnings:** %d  |  **Info:** %d\n\n", F.element_at(F.split(F.col(key).cast("string"), "/"), -1), "errors", "warnings", "infos")
    table = F.when(F.size(lines) > 0, F.concat(F.lit("### Findings\n\n| Severity | Rule | Message |\n|----------|------|---------|\n"), F.array_join(lines, ""), F.lit("\n"))).otherwise("")
    strengths = F.when(F.size(strong) > 0, F.concat(F.lit("### Strengths\n\n"), F.array_join(strong, ""))).otherwise("")
    return rows.select(key, "errors", "warnings", "infos", F.concat(head, table, strengths).alias("report"))


# Which parser reads a file of that ending.
PARSERS = {"json": "json", "xml": "xml", "bwp": "xml", "yaml": "yaml", "yml": "yaml", "properties": "kv", "env": "kv", "conf": "kv"}


def parser_of(name: Column) -> Column:
    """json, xml, yaml, kv or lines by a file name's ending."""
    known = F.create_map(*[F.lit(x) for kv in PARSERS.items() for x in kv])
    return F.coalesce(F.try_element_at(known, F.lower(F.element_at(F.split(name, r"\."), -1))), F.lit("lines"))


def xml_values(content: Column, path: str) -> Column:
    """The texts of the nodes at an XPath; empty where the XML has none."""
    return F.xpath(content, F.lit(path if "/text()" in path or "/@" in path else path.rstrip("/") + "/text()"))


def yaml_to_json(content: Column) -> Column:
    """A YAML document as JSON, so that every condition reads it; null if it is
    not YAML.  Needs a YAML parser on the workers."""
    @F.pandas_udf("string")
    def parsed(texts: pd.Series) -> pd.Series:
        import json

        import yaml

        def one(t):
            try:
                return None if t is None else json.dumps(yaml.safe_load(t), default=str)
            except yaml.YAMLError:
                return None

        return texts.map(one)

    return parsed(content)


def as_json(content: Column, kind: str) -> Column:
    """A document of that parser as JSON for conditions: ``kv`` as an object,
    ``lines`` as a list of texts."""
    return {
        "json": lambda: content, "yaml": lambda: yaml_to_json(content), "kv": lambda: F.to_json(key_values(content)),
        "lines": lambda: F.to_json(F.split(content, r"\r?\n", -1)),
    }[kind]()


def key_values(content: Column) -> Column:
    """map of ``key=value`` lines; blank lines and # comments are skipped; the last of a key wins."""
    rows = F.filter(F.transform(F.split(content, r"\r?\n"), lambda x: F.trim(x)), lambda x: x.contains("=") & ~x.startswith("#"))
    pairs = F.transform(rows, lambda x: F.struct(F.trim(F.substring_index(x, "=", 1)).alias("k"), F.trim(F.substring(x, F.instr(x, "=") + 1, F.length(x))).alias("v")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q.k == p.k))
    return F.map_from_entries(last)


def document_lines(docs: DataFrame, key: str, content: str) -> DataFrame:
    """(key, line_no from 1, line)."""
    return docs.select(key, F.posexplode(F.split(F.col(content), r"\r?\n", -1)).alias("n", "line")).select(key, (F.col("n") + 1).alias("line_no"), "line")
