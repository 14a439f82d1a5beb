"""The scalar function library as column builders, registered by name.

``REGISTRY["math.abs"](col)`` builds a column; all stay inside the JVM.  Where
the semantics are an error, the column raises on that row.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import guard, num, ws_trim

REGISTRY: dict[str, Callable[..., Column]] = {}


def scalar(name: str):
    def add(f):
        REGISTRY[name] = f
        return f

    return add


def _d(c) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast("double")


def _s(c) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast("string")


# math ---------------------------------------------------------------------------
scalar("math.abs")(lambda x: F.abs(_d(x)))
scalar("math.pow")(lambda b, e: F.pow(_d(b), _d(e)))
scalar("math.sqrt")(lambda x: guard(_d(x) < 0, "math.sqrt: negative input", F.sqrt(_d(x))))
scalar("math.log")(lambda x: guard(_d(x) <= 0, "math.log: input must be positive", F.log(_d(x))))
scalar("math.log2")(lambda x: guard(_d(x) <= 0, "math.log2: input must be positive", F.log2(_d(x))))
scalar("math.log10")(lambda x: guard(_d(x) <= 0, "math.log10: input must be positive", F.log10(_d(x))))
scalar("math.sign")(lambda x: F.signum(_d(x)))
scalar("math.clamp")(lambda v, lo, hi: guard(_d(lo) > _d(hi), "math.clamp: min over max", F.least(F.greatest(_d(v), _d(lo)), _d(hi))))


# array --------------------------------------------------------------------------
def _numbers(a: Column, name: str) -> Column:
    n = F.transform(a, lambda x: num(x))
    return guard((F.size(a) == 0) | F.exists(n, lambda x: x.isNull()), f"{name}: needs numbers", n)


scalar("array.min")(lambda a: F.array_min(_numbers(a, "array.min")))
scalar("array.max")(lambda a: F.array_max(_numbers(a, "array.max")))
scalar("array.avg")(lambda a: F.aggregate(_numbers(a, "array.avg"), F.lit(0.0), lambda s, x: s + x) / F.size(a))
scalar("array.unique")(lambda a: F.array_distinct(F.transform(a, lambda x: _s(x))))
scalar("array.indexOf")(lambda a, x: F.coalesce(F.array_position(F.transform(a, lambda y: _s(y)), _s(x)) - 1, F.lit(-1)).cast("int"))
scalar("array.first")(lambda a: F.try_element_at(a, F.lit(1)))
scalar("array.last")(lambda a: F.try_element_at(a, F.lit(-1)))


def _sorted(a: Column, ascending: bool) -> Column:
    """By value if all are numbers, else by text; as text either way."""
    pairs = F.transform(a, lambda x: F.struct(num(x).alias("n"), _s(x).alias("s")))
    numeric = ~F.exists(pairs, lambda p: p.n.isNull())
    keyed = F.when(numeric, F.transform(pairs, lambda p: F.struct(p.n.alias("n"), F.lit("").alias("k"), p.s.alias("s")))).otherwise(F.transform(pairs, lambda p: F.struct(F.lit(0.0).alias("n"), p.s.alias("k"), p.s.alias("s"))))
    return F.transform(F.sort_array(keyed, ascending), lambda p: p.s)


scalar("array.sort")(lambda a: _sorted(a, True))
scalar("array.sortDesc")(lambda a: _sorted(a, False))
scalar("array.sumBy")(lambda a, f: F.aggregate(F.transform(a, lambda x: F.coalesce(x[f].cast("double"), F.lit(0.0))), F.lit(0.0), lambda s, x: s + x))
scalar("array.filter")(lambda a, f, v: F.filter(a, lambda x: _s(x[f]) == F.lit(str(v))))
scalar("array.pluck")(lambda a, f: F.transform(a, lambda x: x[f]))


# string -------------------------------------------------------------------------
def _pad(left: bool):
    def build(s, n, c=" "):
        c = (c or " ")[0]
        fill = F.repeat(F.lit(c), F.greatest(F.lit(0), F.lit(n) - F.length(_s(s))))
        return F.concat(fill, _s(s)) if left else F.concat(_s(s), fill)

    return build


scalar("string.padLeft")(_pad(True))
scalar("string.padRight")(_pad(False))


@scalar("string.mask")
def mask(s, first: int, last: int) -> Column:
    s, n = _s(s), F.length(_s(s))
    return F.when(n <= first + last, s).otherwise(F.concat(F.left(s, F.lit(first)), F.repeat(F.lit("*"), n - first - last), F.right(s, F.lit(last))))


@scalar("string.truncate")
def truncate(s, n: int) -> Column:
    if n < 0:
        raise ValueError("string.truncate: negative length")
    s = _s(s)
    short = F.lit("." * n) if n < 3 else F.concat(F.left(s, F.lit(n - 3)), F.lit("..."))
    return F.when(F.length(s) <= n, s).otherwise(short)


scalar("string.isBlank")(lambda s: F.coalesce(ws_trim(_s(s)) == "", F.lit(True)))
scalar("string.isNumeric")(lambda s: F.coalesce(ws_trim(_s(s)).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"), F.lit(False)))


def _words(s: Column) -> Column:
    spaced = F.regexp_replace(_s(s), r"([\p{Ll}\d])(\p{Lu})", "$1 $2")
    return F.filter(F.split(spaced, r"[\s_-]+"), lambda w: w != "")


scalar("string.snakeCase")(lambda s: F.array_join(F.transform(_words(s), lambda w: F.lower(w)), "_"))
scalar("string.camelCase")(lambda s: F.array_join(F.transform(_words(s), lambda w, i: F.when(i == 0, F.lower(w)).otherwise(F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substring(w, F.lit(2), F.length(w)))))), ""))
scalar("string.regexExtract")(lambda s, p: F.regexp_extract(_s(s), p, min(1, re.compile(p).groups)))


@scalar("string.format")
def fmt(template: str, *args) -> Column:
    if not args:
        return F.lit(template)
    return F.format_string(re.sub(r"%t", "%b", re.sub(r"%v", "%s", template)), *args)


# util ---------------------------------------------------------------------------
scalar("util.coalesce")(lambda *cs: F.coalesce(*[F.nullif(_s(c), F.lit("")) for c in cs]))
scalar("util.sha256")(lambda s: F.sha2(_s(s), 256))
scalar("util.md5")(lambda s: F.md5(_s(s)))


@scalar("util.hmacSha256")
def hmac_sha256(message, key: str) -> Column:
    import hashlib

    raw = key.encode()
    block = (hashlib.sha256(raw).digest() if len(raw) > 64 else raw).ljust(64, b"\0")
    inner, outer = (F.unhex(F.lit(bytes(b ^ x for b in block).hex())) for x in (0x36, 0x5C))
    first = F.unhex(F.sha2(F.concat(inner, F.to_binary(_s(message), F.lit("utf-8"))), 256))
    return F.sha2(F.concat(outer, first), 256)


scalar("util.base64UrlEncode")(lambda s: F.translate(F.regexp_replace(F.base64(_s(s).cast("binary")), r"[=\r\n]", ""), "+/", "-_"))
scalar("util.base64UrlDecode")(lambda s: F.decode(F.unbase64(F.translate(F.regexp_replace(_s(s), "=", ""), "-_", "+/")), "utf-8"))


# datetime -----------------------------------------------------------------------
FORMATS = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


ZONED = 2  # so many of them have an offset; the others mean UTC


def when(s) -> Column:
    """Timestamp of a date text in one of ``FORMATS``, in UTC where it has no
    offset, whatever the session's zone; others raise."""
    s = _s(s)
    read = [F.try_to_timestamp(s, F.lit(f)) for f in FORMATS]
    t = F.coalesce(*read[:ZONED], *[F.from_utc_timestamp(x, F.current_timezone()) for x in read[ZONED:]])
    return F.when(s.isNotNull() & t.isNull(), F.raise_error(F.concat(F.lit("not a date: "), s)).cast("timestamp")).otherwise(t)


def utc(t: Column) -> Column:
    """The timestamp whose fields in the session's zone are those of ``t`` in UTC."""
    return F.to_utc_timestamp(t, F.current_timezone())


def shown(u: Column) -> Column:
    return F.date_format(u, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def own_day(s) -> Column:
    """The calendar day in the value's own offset."""
    return F.to_date(F.left(_s(s), F.lit(10)))


scalar("datetime.isBefore")(lambda a, b: when(a) < when(b))
scalar("datetime.isAfter")(lambda a, b: when(a) > when(b))
scalar("datetime.toEpoch")(lambda s: F.unix_millis(when(s)))
scalar("datetime.fromEpoch")(lambda ms: shown(utc(F.timestamp_millis(ms.cast("long")))))
scalar("datetime.isWeekend")(lambda s: F.dayofweek(own_day(s)).isin(1, 7))
scalar("datetime.isWeekday")(lambda s: ~F.dayofweek(own_day(s)).isin(1, 7))
scalar("datetime.startOfDay")(lambda s: shown(F.date_trunc("DAY", utc(when(s)))))
scalar("datetime.quarter")(lambda s: F.quarter(utc(when(s))))


@scalar("datetime.addBusinessDays")
def add_business_days(s, n: int) -> Column:
    """Whole weeks at once, then the rest day by day; time of day is kept."""
    t = utc(when(s))
    if not n:
        return shown(t)
    sign = 1 if n > 0 else -1
    weeks, rest = divmod(abs(n), 5)
    # a weekend start counts from the weekday before (after, going back)
    iso = F.weekday(t)  # 0 is Monday
    shift = F.when(iso >= 5, (iso - 4) * -1 if sign > 0 else 7 - iso).otherwise(0)
    base = iso + shift
    over = F.when(base + rest > 4, 2).otherwise(0) if sign > 0 else F.when(F.pmod(base, F.lit(7)) - rest < 0, 2).otherwise(0)
    landing = shift + sign * (7 * weeks + rest + over)
    return shown(t + F.make_dt_interval(landing.cast("int")))


# number, json -------------------------------------------------------------------
@scalar("number.randomInt")
def random_int(lo: int, hi: int) -> Column:
    if lo > hi:
        raise ValueError("number.randomInt: min over max")
    return (F.floor(F.rand() * (hi - lo + 1)) + lo).cast("int")


scalar("json.removeKey")(lambda m, k: F.map_filter(m, lambda key, _: key != F.lit(k)))


@scalar("json.merge")
def merge(first, second, *more) -> Column:
    """Shallow; later maps win."""
    out = first
    for m in (second, *more):
        out = _merged(out, m)
    return out


def _merged(a: Column, b: Column) -> Column:
    return F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)
