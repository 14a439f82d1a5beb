"""Predicates ``{field, operator, value}`` compiled to columns.

A null field counts as missing.  An operator that needs numbers and finds none
gives an evaluation error, which is a value of the row, not an exception.
Decisions where variants of these semantics differ: a missing field passed
through is skipped in both modes; an empty list passes in both modes.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import go_text, num

NUMERIC = {"gt": ">", "gte": ">=", "lt": "<", "lte": "<="}
OPERATORS = ("eq", "neq", *NUMERIC, "contains", "startsWith", "endsWith", "regex")


@dataclass(frozen=True)
class Predicate:
    field: str
    operator: str
    value: str

    def __post_init__(self):
        if not self.field:
            raise ValueError("a predicate needs a field")
        if self.operator not in OPERATORS:
            raise ValueError(f"unsupported operator {self.operator!r}")
        if self.operator == "regex":
            if re.search(r"\(\?<?[=!]|\\[1-9]", self.value):
                raise ValueError("look-around and back-references are not supported")
            re.compile(self.value)


def _number(text: str) -> float | None:
    try:
        return float(text)
    except ValueError:
        return None


def single(p: Predicate, dtype: str) -> Column:
    """struct<passed, reason, error> of a field that is present."""
    field, value = F.col(f"`{p.field}`"), p.value
    text, n, want = go_text(field, dtype), num(field), _number(p.value)
    if p.operator in ("contains", "startsWith", "endsWith", "regex"):
        test = {"contains": F.contains, "startsWith": F.startswith, "endsWith": F.endswith}.get(p.operator)
        ok = text.rlike(value) if p.operator == "regex" else test(text, F.lit(value))
        says = {"contains": "does not contain", "startsWith": "does not start with", "endsWith": "does not end with", "regex": "does not match regex"}[p.operator]
        return _outcome(ok, F.concat(F.lit('"'), text, F.lit(f'" {says} "{value}"')))
    if p.operator in NUMERIC:
        error = F.lit(f'operator "{p.operator}" requires numeric operands; field "{p.field}" is not numeric')
        if want is None:
            return F.struct(F.lit(False).alias("passed"), F.lit("").alias("reason"), error.alias("error"))
        ok = {"gt": n > want, "gte": n >= want, "lt": n < want, "lte": n <= want}[p.operator]
        r = _outcome(ok, F.format_string(f"%.4f is not {NUMERIC[p.operator]} {want:.4f}", n))
        return F.when(n.isNull(), F.struct(F.lit(False).alias("passed"), F.lit("").alias("reason"), error.alias("error"))).otherwise(r)
    same = text == value if want is None else F.coalesce(n == want, text == value)
    neq = p.operator == "neq"
    shown = F.concat(F.lit('"'), text, F.lit(f'" {"==" if neq else "!="} "{value}"' + (" (equal)" if neq else "")))
    if want is not None:
        shown = F.when(n.isNull(), shown).otherwise(F.format_string(f"%.4f {'==' if neq else '!='} {want:.4f}" + (" (equal)" if neq else ""), n))
    return _outcome(~same if neq else same, shown)


def _outcome(ok: Column, reason: Column) -> Column:
    return F.struct(ok.alias("passed"), F.when(ok, "").otherwise(reason).alias("reason"), F.lit("").alias("error"))


def evaluate(df: DataFrame, predicates: list[Predicate], mode: str = "and", pass_missing: bool = False) -> Column:
    """struct<passed, reason, error> of the list: AND stops at the first
    failure, OR at the first pass, either at the first error."""
    if mode not in ("and", "or"):
        raise ValueError("mode is 'and' or 'or'")
    types = dict(df.dtypes)
    done = F.struct(F.lit(True if mode == "and" or not predicates else False).alias("passed"), F.lit("").alias("reason"), F.lit("").alias("error"))
    outcomes = []
    for p in predicates:
        missing = F.lit(None).cast("struct<passed:boolean,reason:string,error:string>") if pass_missing else F.struct(F.lit(False).alias("passed"), F.lit(f'field "{p.field}" not found').alias("reason"), F.lit("").alias("error"))
        if p.field not in types:
            outcomes.append(missing)
        else:
            outcomes.append(F.when(F.col(f"`{p.field}`").isNull(), missing).otherwise(single(p, types[p.field])))
    if not predicates:
        return done
    if mode == "and":
        return F.coalesce(*[F.when(~o.passed, o) for o in outcomes], done)
    reasons = F.concat_ws("; ", *[o.reason for o in outcomes])
    none = F.struct(F.lit(False).alias("passed"), reasons.alias("reason"), F.lit("").alias("error"))
    return F.coalesce(*[F.when(o.passed | (o.error != ""), o) for o in outcomes], none)


INTEGRAL = ("tinyint", "smallint", "int", "bigint")
REAL = ("float", "double")


def plain(p: Predicate, dtype: str) -> Column | None:
    """The predicate as a comparison of the typed column, which reaches the scan;
    null where the field is missing.  None if it has no such form, or if it may
    be an error."""
    field, want = F.col(f"`{p.field}`"), _number(p.value)
    if dtype == "string":
        if p.operator in ("eq", "neq") and want is None:
            return field == p.value if p.operator == "eq" else field != p.value
        test = {"contains": F.contains, "startsWith": F.startswith, "endsWith": F.endswith}.get(p.operator)
        return test(field, F.lit(p.value)) if test else field.rlike(p.value) if p.operator == "regex" else None
    if want is None or not math.isfinite(want) or p.operator not in ("eq", "neq", *NUMERIC):
        return None
    if dtype in INTEGRAL and abs(want) < 2**31:  # whole bounds, so that the column is not cast
        low, high = math.floor(want), math.ceil(want)
        if p.operator in ("eq", "neq") and low != high:
            return None
        return {"gt": field > low, "gte": field >= high, "lt": field < high, "lte": field <= low, "eq": field == low, "neq": field != low}[p.operator]
    if dtype == "double":
        return {"gt": field > want, "gte": field >= want, "lt": field < want, "lte": field <= want, "eq": field == want, "neq": field != want}[p.operator]
    return None


def passes(df: DataFrame, predicates: list[Predicate], mode: str = "and", pass_missing: bool = False) -> Column | None:
    """What ``evaluate`` lets through, as one Boolean of plain comparisons; None
    if a predicate has none."""
    types, terms = dict(df.dtypes), []
    if mode not in ("and", "or"):
        raise ValueError("mode is 'and' or 'or'")
    for p in predicates:
        if p.field not in types:
            terms.append(F.lit(mode == "and" and pass_missing))
            continue
        c = plain(p, types[p.field])
        if c is None:
            return None
        terms.append(c | F.col(f"`{p.field}`").isNull() if pass_missing and mode == "and" else c)
    return reduce(lambda a, b: a & b if mode == "and" else a | b, terms) if terms else F.lit(True)


def filter_rows(df: DataFrame, predicates: list[Predicate], mode: str = "and", pass_missing: bool = False, keep_all: bool = False) -> DataFrame:
    """The rows that pass; with ``keep_all``, all of them with ``outcome``
    (pass, blocked, evalError), ``reason`` and ``eval_error``."""
    if not keep_all and (plainly := passes(df, predicates, mode, pass_missing)) is not None:
        return df.where(plainly)
    r = evaluate(df, predicates, mode, pass_missing)
    if not keep_all:
        return df.where(r.passed)
    shown = df.withColumn("__r", r)
    kind = F.when(F.col("__r.error") != "", "evalError").when(F.col("__r.passed"), "pass").otherwise("blocked")
    return shown.select(*df.columns, kind.alias("outcome"), F.col("__r.reason").alias("reason"), F.col("__r.error").alias("eval_error"))


def with_defaults(handler: dict, trigger: dict) -> dict:
    """A handler's operator and mode, or else its trigger's; its predicates."""
    operator = handler.get("operator") or trigger.get("operator") or "eq"
    listed = handler.get("predicates") or ([handler] if handler.get("field") else [])
    predicates = [Predicate(p["field"], p.get("operator") or operator, str(p.get("value", ""))) for p in listed]
    return {"predicates": predicates, "mode": (handler.get("predicateMode") or trigger.get("predicateMode") or "and").lower()}


def judge_rows(df: DataFrame, predicates: list[Predicate], mode: str = "and", pass_missing: bool = False, duplicate: Column | None = None) -> DataFrame:
    """All rows, with ``passed``, ``reason`` and ``error_message``; rows that
    ``duplicate`` holds for do not pass, for the reason ``duplicate``."""
    r = evaluate(df, predicates, mode, pass_missing)
    again = F.coalesce(duplicate, F.lit(False)) if duplicate is not None else F.lit(False)
    shown = df.select("*", r.alias("__r"), again.alias("__d"))
    passed = F.col("__r.passed") & ~F.col("__d")
    reason = F.when(F.col("__r.passed") & F.col("__d"), "duplicate").otherwise(F.col("__r.reason"))
    return shown.select(*df.columns, passed.alias("passed"), reason.alias("reason"), F.col("__r.error").alias("error_message"))


@dataclass(frozen=True)
class Route:
    name: str
    predicates: tuple[Predicate, ...] = ()
    mode: str = "and"
    priority: int = 0


def split(df: DataFrame, routes: list[Route], first_match: bool = True, tap: bool = False, errors: bool = True) -> DataFrame:
    """Rows with a ``route``: matched ones by ascending priority (the first
    alone, or all), ``unmatched`` where none did, in addition ``evalError`` where
    a predicate failed to evaluate, and ``all`` for every row if ``tap``.
    ``eval_error`` is the first error before the first match.  A route without
    predicates always matches."""
    order = sorted(routes, key=lambda r: r.priority)
    results = F.array(*[F.struct(F.lit(r.name).alias("name"), evaluate(df, list(r.predicates), r.mode).alias("r")) for r in order])
    shown = df.withColumn("__all", results)
    passed = F.filter("__all", lambda x: x.r.passed)
    if first_match:
        until = F.coalesce(F.nullif(F.array_position(F.transform("__all", lambda x: x.r.passed), F.lit(True)), F.lit(0)), F.lit(len(order))).cast("int")
        passed, seen = F.slice(passed, 1, 1), F.slice("__all", F.lit(1), until)
    else:
        seen = F.col("__all")
    error = F.coalesce(F.try_element_at(F.transform(F.filter(seen, lambda x: x.r.error != ""), lambda x: x.r.error), F.lit(1)), F.lit(""))
    names = F.transform(passed, lambda x: x["name"])
    out = F.when(F.size(names) == 0, F.array(F.lit("unmatched"))).otherwise(names)
    if errors:
        out = F.concat(out, F.when(error != "", F.array(F.lit("evalError"))).otherwise(F.array().cast("array<string>")))
    if tap:
        out = F.concat(out, F.array(F.lit("all")))
    return shown.select(*df.columns, F.explode(out).alias("route"), error.alias("eval_error"))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
