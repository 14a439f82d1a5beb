"""Named queries over the tables, with the SQL that checks them.

Messages are the ``events`` table in (ts, event_id) order, keyed by user, with
the event type as topic.  Every query reads its whole tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as _text  # noqa: F401  registers text functions
from ..functions.scalar import REGISTRY as fn
from ..operators import changes, chunks, joins, models, predicates, rules, shaping, vectors, windows
from ..operators.predicates import Predicate, Route
from ..sources.tables import decode_json, table

ORDER = ["ts", "event_id"]
_queries: dict = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        _queries[name or f.__name__] = f
        if sql:
            _sql[name or f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def _us(df, c, out):
    from ..functions.core import micros

    return micros(df, c).alias(out)


# predicates and routing -----------------------------------------------------------
@query("SELECT event_id, user_id, value FROM events WHERE value > 50")
def filter_numeric_gt(spark, d):
    return predicates.filter_rows(table(spark, d, "events"), [Predicate("value", "gt", "50")]).select("event_id", "user_id", "value")


@query("SELECT event_id, event_type FROM events WHERE event_type = 'click'")
def filter_string_eq_fallback(spark, d):
    return predicates.filter_rows(table(spark, d, "events"), [Predicate("event_type", "eq", "click")]).select("event_id", "event_type")


@query("SELECT event_id FROM events WHERE value >= 20 AND user_id < 100 AND event_type <> 'view'")
def filter_multi_and(spark, d):
    return predicates.filter_rows(table(spark, d, "events"), [Predicate("value", "gte", "20"), Predicate("user_id", "lt", "100"), Predicate("event_type", "neq", "view")]).select("event_id")


@query("SELECT event_id FROM events WHERE value > 90 OR user_id = 7 OR contains(event_type, 'ur')")
def filter_multi_or(spark, d):
    return predicates.filter_rows(table(spark, d, "events"), [Predicate("value", "gt", "90"), Predicate("user_id", "eq", "7"), Predicate("event_type", "contains", "ur")], "or").select("event_id")


@query("SELECT event_id, event_type FROM events WHERE regexp_matches(event_type, '^[cp][a-z]+k?') OR starts_with(event_type, 'si') OR ends_with(event_type, 'ew')")
def filter_regex(spark, d):
    return predicates.filter_rows(table(spark, d, "events"), [Predicate("event_type", "regex", "^[cp][a-z]+k?"), Predicate("event_type", "startsWith", "si"), Predicate("event_type", "endsWith", "ew")], "or").select("event_id", "event_type")


@query("""SELECT event_id, CASE WHEN value <= 50 THEN 'blocked' ELSE 'evalError' END AS outcome,
 CASE WHEN value <= 50 THEN printf('%.4f is not > 50.0000', value) ELSE '' END AS reason,
 CASE WHEN value <= 50 THEN '' ELSE 'operator "lt" requires numeric operands; field "event_type" is not numeric' END AS eval_error FROM events""")
def filter_reason_columns(spark, d):
    return predicates.filter_rows(table(spark, d, "events"), [Predicate("value", "gt", "50"), Predicate("event_type", "lt", "5")], keep_all=True).select("event_id", "outcome", "reason", "eval_error")


ROUTES = [Route("high", (Predicate("value", "gt", "80"),), priority=1), Route("mid", (Predicate("value", "gt", "40"),), priority=2), Route("buyers", (Predicate("event_type", "eq", "purchase"),), priority=3)]


@query("SELECT event_id, CASE WHEN value > 80 THEN 'high' WHEN value > 40 THEN 'mid' WHEN event_type = 'purchase' THEN 'buyers' ELSE 'unmatched' END AS route FROM events")
def split_first_match(spark, d):
    return predicates.split(table(spark, d, "events"), ROUTES).select("event_id", "route")


@query("""SELECT event_id, 'high' AS route FROM events WHERE value > 80 UNION ALL SELECT event_id, 'mid' FROM events WHERE value > 40
 UNION ALL SELECT event_id, 'buyers' FROM events WHERE event_type = 'purchase' UNION ALL SELECT event_id, 'all' FROM events
 UNION ALL SELECT event_id, 'unmatched' FROM events WHERE NOT (value > 80 OR value > 40 OR event_type = 'purchase')""")
def split_all_match(spark, d):
    return predicates.split(table(spark, d, "events"), ROUTES, first_match=False, tap=True).select("event_id", "route")


# windows --------------------------------------------------------------------------
def _tumbling_count(function):
    agg = "count(*)::DOUBLE" if function == "count" else f"{function}(value)"
    sql = f"""WITH e AS (SELECT user_id::VARCHAR AS key, value, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 3 AS window_no FROM events)
 SELECT key, window_no, round({agg}, 4) AS value, count(*) AS count FROM e GROUP BY ALL HAVING count(*) = 3"""

    @query(sql, f"window_tumbling_count_{function}")
    def run(spark, d):
        out = windows.tumbling_count(table(spark, d, "events"), 3, "value", "user_id", ORDER, function)
        return out.select(F.col("key").cast("string").alias("key"), "window_no", F.round("value", 4).alias("value"), "count")


for _f in windows.FUNCTIONS:
    _tumbling_count(_f)


def _anchored(key, hours):
    k = "user_id::VARCHAR" if key else "''"
    return f"""WITH RECURSIVE e AS (SELECT {k} AS key, ts, value, row_number() OVER (PARTITION BY {k} ORDER BY ts, event_id) AS n FROM events),
 w AS (SELECT key, n, ts AS start, ts AS cur, 0 AS win FROM e WHERE n = 1
  UNION ALL SELECT e.key, e.n, CASE WHEN (epoch_us(e.ts) - epoch_us(w.start)) // 1000 >= {hours} * 3600000 THEN e.ts ELSE w.start END, e.ts,
   CASE WHEN (epoch_us(e.ts) - epoch_us(w.start)) // 1000 >= {hours} * 3600000 THEN w.win + 1 ELSE w.win END FROM w JOIN e ON e.key = w.key AND e.n = w.n + 1),
 g AS (SELECT w.key, w.win, min(w.start) AS start, round(sum(e.value), 4) AS value, count(*) AS count FROM w JOIN e USING (key, n) GROUP BY w.key, w.win)
 SELECT key, value, count, epoch_us(start) AS window_start_us, epoch_us(lead(start) OVER (PARTITION BY key ORDER BY win)) AS closed_at_us FROM g QUALIFY closed_at_us IS NOT NULL"""


def _closed(out):
    return out.where("kind = 'closed'").select("key", F.round("value", 4).alias("value"), "count", _us(out, "window_start", "window_start_us"), _us(out, "closed_at", "closed_at_us"))


@query(_anchored(True, 6))
def window_tumbling_time_keyed(spark, d):
    return _closed(windows.tumbling_time(table(spark, d, "events"), windows.Settings(6 * 3_600_000), "value", "ts", "user_id", ORDER))


@query(_anchored(False, 1))
def window_tumbling_time_unkeyed(spark, d):
    return _closed(windows.tumbling_time(table(spark, d, "events"), windows.Settings(3_600_000), "value", "ts", None, ORDER))


@query("SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 4 PRECEDING), 4) AS value_out FROM events")
def window_sliding_count(spark, d):
    return windows.sliding_count(table(spark, d, "events"), 5, "value", "user_id", ORDER, "avg").select("event_id", F.round("value_out", 4).alias("value_out"))


_LATER = "b.user_id = e.user_id AND (b.ts < e.ts OR b.ts = e.ts AND b.event_id <= e.event_id) AND epoch_us(b.ts) // 1000 >= epoch_us(e.ts) // 1000 - {}"


def _with_ms(spark, d):
    e = table(spark, d, "events")
    return e.withColumn("ms", F.floor(_us(e, "ts", "us") / 1000))


@query(f"SELECT e.event_id, round(sum(b.value), 4) AS value_out FROM events e JOIN events b ON {_LATER.format(86400000)} GROUP BY 1")
def window_sliding_time(spark, d):
    return windows.sliding_time(_with_ms(spark, d), 86_400_000, "value", "user_id", "ms", order=ORDER, ascending=True).select("event_id", F.round("value_out", 4).alias("value_out"))


@query(f"SELECT e.event_id, max(b.value) AS value_out FROM events e JOIN events b ON {_LATER.format(43200000)} GROUP BY 1")
def window_sliding_time_max(spark, d):
    return windows.sliding_time(_with_ms(spark, d), 43_200_000, "value", "user_id", "ms", "max", order=ORDER).select("event_id", "value_out")


@query(_anchored(True, 6).split(" SELECT key, value, count, epoch_us(start)")[0] + """, m AS (SELECT key, epoch_us(max(ts)) AS watermark_us FROM e GROUP BY 1)
 SELECT key, count AS buffered, win::BIGINT AS closed, 0::BIGINT AS late, watermark_us FROM g JOIN m USING (key) QUALIFY row_number() OVER (PARTITION BY key ORDER BY win DESC) = 1""")
def window_metrics(spark, d):
    found = windows.tumbling_time(table(spark, d, "events"), windows.Settings(6 * 3_600_000), "value", "ts", "user_id", ORDER, with_open=True)
    out = windows.window_metrics(found)
    return out.select("key", "buffered", "closed", "late", _us(out, "watermark", "watermark_us"))


@query("WITH k AS (SELECT user_id FROM events GROUP BY 1 ORDER BY min(ROW(ts, event_id)) LIMIT 20) SELECT event_id FROM events JOIN k USING (user_id)")
def window_max_keys(spark, d):
    return windows.admit_keys(table(spark, d, "events"), "user_id", ORDER, 20)[0].select("event_id")


@query("SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events")
def event_time_forms(spark, d):
    """Milliseconds as a text, RFC 3339, and a number that goes first."""
    e = _with_ms(spark, d)
    as_text = F.when(F.col("event_id") % 2 == 0, F.col("ms").cast("string")).otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z")))
    rows = e.select("event_id", F.when(F.col("event_id") % 5 == 0, "no time").otherwise(as_text).alias("t"), F.when(F.col("event_id") % 5 == 0, F.col("ms").cast("double")).alias("first"))
    return rows.select("event_id", F.unix_millis(windows.event_time(rows, "t", "first")).alias("ms"))


@query("""WITH e AS (SELECT user_id::VARCHAR AS key, ts, value, coalesce(max(ts) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING), ts) AS mark FROM events)
 SELECT key, value, epoch_us(ts) AS ts_us, epoch_us(mark) AS watermark_us FROM e WHERE (epoch_us(mark) - epoch_us(ts)) // 1000 > 3600000""")
def window_late_events(spark, d):
    """Arrival in id order; events over an hour behind their key's latest are late."""
    out = windows.tumbling_time(table(spark, d, "events"), windows.Settings(6 * 3_600_000, allowed_lateness_ms=3_600_000), "value", "ts", "user_id", ["event_id"])
    return out.where("kind = 'late'").select("key", "value", _us(out, "closed_at", "ts_us"), _us(out, "watermark", "watermark_us"))


@query("""WITH RECURSIVE e AS (SELECT event_id, event_type || '-' || user_id AS id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS n FROM events),
 w AS (SELECT id, n, event_id, us AS seen, TRUE AS fresh FROM e WHERE n = 1 UNION ALL
  SELECT e.id, e.n, e.event_id, CASE WHEN e.us >= w.seen + 86400000000 THEN e.us ELSE w.seen END, e.us >= w.seen + 86400000000 FROM w JOIN e ON e.id = w.id AND e.n = w.n + 1)
 SELECT event_id, id FROM w WHERE fresh""")
def dedup_ttl(spark, d):
    e = table(spark, d, "events").select("event_id", "ts", F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("id"))
    return windows.dedup_ttl(e, "id", "ts", 86_400_000, ORDER).select("event_id", "id")


def _bucket_sql(rate, burst, wait_s):
    """The token bucket as a recursive query; DOUBLE steps in the fold's order."""
    return f"""WITH RECURSIVE e AS (SELECT event_id, user_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
 w AS (SELECT user_id, n, event_id, us, {burst}::DOUBLE - 1 AS tokens, TRUE AS ok FROM e WHERE n = 1 UNION ALL
  SELECT user_id, n, event_id, us, CASE WHEN ok THEN t - 1 ELSE t END, ok FROM (SELECT *, t >= 1 OR (1 - t) * 1e6 <= {wait_s}::DOUBLE * 1e6 * ({rate}) AS ok FROM (
   SELECT e.user_id, e.n, e.event_id, e.us, least({burst}::DOUBLE, w.tokens + (e.us - w.us)::DOUBLE / 1e6 * ({rate})) AS t FROM w JOIN e ON e.user_id = w.user_id AND e.n = w.n + 1)))
 SELECT event_id, user_id FROM w WHERE ok"""


@query(_bucket_sql("1::DOUBLE / 86400", 3, 0))
def rate_limit_by_user(spark, d):
    return windows.rate_limit(table(spark, d, "events"), "ts", 1 / 86_400, 3, "user_id", ORDER).select("event_id", "user_id")


@query(_bucket_sql("1::DOUBLE / 86400", 2, 21_600))
def rate_limit_wait(spark, d):
    return windows.rate_limit(table(spark, d, "events"), "ts", 1 / 86_400, 2, "user_id", ORDER, 21_600_000).select("event_id", "user_id")


@query("""SELECT event_id, value > 50 AND event_id % 7 <> 0 AS passed, CASE WHEN value <= 50 THEN printf('%.4f is not > 50.0000', value) WHEN event_id % 7 = 0 THEN 'duplicate' ELSE '' END AS reason, '' AS error_message FROM events""")
def filter_judge_rows(spark, d):
    made = predicates.with_defaults({"predicates": [{"field": "value", "value": 50}]}, {"operator": "gt", "predicateMode": "and"})
    out = predicates.judge_rows(table(spark, d, "events"), duplicate=F.col("event_id") % 7 == 0, **made)
    return out.select("event_id", "passed", "reason", "error_message")


# keyed joins ----------------------------------------------------------------------
def _join_sql(topics, window_us, end, kind):
    """The fold as a recursive query: one state row an event."""
    n = len(topics)
    names = ", ".join(f"'{t}'" for t in topics)
    slots = lambda prev: ", ".join(f"CASE WHEN e.topic = '{t}' THEN e.p WHEN {prev} THEN NULL ELSE w.s{i} END AS s{i}" for i, t in enumerate(topics))
    full = " AND ".join(f"w.s{i} IS NOT NULL" for i in range(n))
    old = f"({full}) OR e.us - w.created >= {window_us}"
    first = ", ".join(f"CASE WHEN topic = '{t}' THEN p END AS s{i}" for i, t in enumerate(topics))
    shown = ", ".join(f"s{i}" for i in range(n))
    base = f"""WITH RECURSIVE e AS (SELECT user_id::VARCHAR AS key, event_type AS topic, event_id::VARCHAR AS p, epoch_us(ts) AS us,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE event_type IN ({names})),
 w AS (SELECT key, n, us AS created, us, {first} FROM e WHERE n = 1 UNION ALL
  SELECT e.key, e.n, CASE WHEN {old} THEN e.us ELSE w.created END, e.us, {slots(old)} FROM w JOIN e ON e.key = w.key AND e.n = w.n + 1)"""
    if kind == "joined":
        return f"{base} SELECT key AS join_key, created AS created_us, us AS fired_us, {shown} FROM w WHERE " + " AND ".join(f"s{i} IS NOT NULL" for i in range(n))
    return f"""{base}, x AS (SELECT *, coalesce(lead(us) OVER (PARTITION BY key ORDER BY n), {end}) AS next FROM w)
 SELECT key AS join_key, created AS created_us, {shown} FROM x WHERE NOT ({" AND ".join(f"s{i} IS NOT NULL" for i in range(n))}) AND next - created >= {window_us}"""


def _join(spark, d, topics, hours, end=None):
    return joins.keyed_join(table(spark, d, "events"), topics, "event_type", "user_id", "ts", "event_id", hours * 3_600_000, ORDER, end)


def _slots(topics):
    return [F.col("messages")[t].alias(f"s{i}") for i, t in enumerate(topics)]


TWO, THREE = ["click", "purchase"], ["click", "purchase", "view"]


@query(_join_sql(TWO, 86_400_000_000, None, "joined"))
def join_two_topics_lww(spark, d):
    out = _join(spark, d, TWO, 24)
    return out.where("kind = 'joined'").select("join_key", _us(out, "created_at", "created_us"), _us(out, "fired_at", "fired_us"), *_slots(TWO))


@query(_join_sql(THREE, 172_800_000_000, None, "joined"))
def join_three_topics(spark, d):
    out = _join(spark, d, THREE, 48)
    return out.where("kind = 'joined'").select("join_key", _us(out, "created_at", "created_us"), _us(out, "fired_at", "fired_us"), *_slots(THREE))


@query(_join_sql(TWO, 21_600_000_000, "epoch_us(TIMESTAMP '2030-01-01')", "timeout"))
def join_timeout_partial(spark, d):
    out = _join(spark, d, TWO, 6, "2030-01-01")
    return out.where("kind = 'timeout'").select("join_key", _us(out, "created_at", "created_us"), *_slots(TWO))


# functions ------------------------------------------------------------------------
@query("""SELECT event_id, abs(value - 50) AS a, round(pow(value, 2), 4) AS p, round(sqrt(value), 6) AS q, round(ln(value + 1), 6) AS l, round(log2(value + 1), 6) AS l2,
 round(log10(value + 1), 6) AS l10, sign(value - 50)::DOUBLE AS s, least(greatest(value, 20.0), 80.0)::DOUBLE AS c FROM events""")
def fn_math_all(spark, d):
    v = F.col("value")
    return table(spark, d, "events").select("event_id", fn["math.abs"](v - 50).alias("a"), F.round(fn["math.pow"](v, 2), 4).alias("p"), F.round(fn["math.sqrt"](v), 6).alias("q"), F.round(fn["math.log"](v + 1), 6).alias("l"), F.round(fn["math.log2"](v + 1), 6).alias("l2"), F.round(fn["math.log10"](v + 1), 6).alias("l10"), fn["math.sign"](v - 50).alias("s"), fn["math.clamp"](v, 20, 80).alias("c"))


@query("""WITH a AS (SELECT l_orderkey, list(l_quantity::BIGINT::VARCHAR ORDER BY l_linenumber, l_quantity::BIGINT::VARCHAR) AS q FROM lineitem GROUP BY 1)
 SELECT l_orderkey, array_to_string(list_transform(list_sort(list_transform(q, lambda x: x::DOUBLE)), lambda x: x::BIGINT::VARCHAR), ',') AS s,
 array_to_string(list_transform(list_reverse_sort(list_transform(q, lambda x: x::DOUBLE)), lambda x: x::BIGINT::VARCHAR), ',') AS r,
 len(list_distinct(q))::INTEGER AS n, list_min(list_transform(q, lambda x: x::DOUBLE)) AS mn, list_max(list_transform(q, lambda x: x::DOUBLE)) AS mx,
 round(list_avg(list_transform(q, lambda x: x::DOUBLE)), 6) AS av, coalesce(list_position(q, '10') - 1, -1)::INTEGER AS i, q[1] AS f, q[-1] AS z FROM a""")
def fn_array_sort_unique(spark, d):
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", F.col("l_quantity").cast("long").cast("string").alias("q"))))
    a = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(rows, lambda r: r.q).alias("q"))
    q = F.col("q")
    return a.select("l_orderkey", F.array_join(fn["array.sort"](q), ",").alias("s"), F.array_join(fn["array.sortDesc"](q), ",").alias("r"), F.size(fn["array.unique"](q)).alias("n"), fn["array.min"](q).alias("mn"), fn["array.max"](q).alias("mx"), F.round(fn["array.avg"](q), 6).alias("av"), fn["array.indexOf"](q, "10").alias("i"), fn["array.first"](q).alias("f"), fn["array.last"](q).alias("z"))


@query("""SELECT l_orderkey, round(sum(l_extendedprice), 2) AS total, array_to_string(list(l_linenumber::VARCHAR ORDER BY l_linenumber), ',') AS numbers,
 count(*) FILTER (l_returnflag = 'R')::INTEGER AS returned FROM lineitem GROUP BY 1""")
def fn_array_sumby_pluck(spark, d):
    a = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_extendedprice", "l_returnflag"))).alias("a"))
    return a.select("l_orderkey", F.round(fn["array.sumBy"](F.col("a"), "l_extendedprice"), 2).alias("total"), F.array_join(F.transform(fn["array.pluck"](F.col("a"), "l_linenumber"), lambda x: x.cast("string")), ",").alias("numbers"), F.size(fn["array.filter"](F.col("a"), "l_returnflag", "R")).alias("returned"))


@query("""SELECT c_custkey, CASE WHEN length(c_mktsegment) >= 12 THEN c_mktsegment ELSE lpad(c_mktsegment, 12, '*') END AS l, CASE WHEN length(c_mktsegment) >= 9 THEN c_mktsegment ELSE rpad(c_mktsegment, 9, ' ') END AS r,
 CASE WHEN length(c_name) <= 5 THEN c_name ELSE left(c_name, 3) || repeat('*', length(c_name) - 5) || right(c_name, 2) END AS m,
 CASE WHEN length(c_name) <= 8 THEN c_name ELSE left(c_name, 5) || '...' END AS t, trim(c_name) = '' AS b,
 regexp_matches(right(c_name, 4), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') AS n FROM customer""")
def fn_string_pad_mask_truncate(spark, d):
    s, n = F.col("c_mktsegment"), F.col("c_name")
    return table(spark, d, "customer").select("c_custkey", fn["string.padLeft"](s, 12, "*").alias("l"), fn["string.padRight"](s, 9).alias("r"), fn["string.mask"](n, 3, 2).alias("m"), fn["string.truncate"](n, 8).alias("t"), fn["string.isBlank"](n).alias("b"), fn["string.isNumeric"](F.right(n, F.lit(4))).alias("n"))


@query("""SELECT p_partkey, array_to_string(list_transform(string_split(p_type, ' '), lambda x: lower(x)), '_') AS snake,
 lower(string_split(p_type, ' ')[1]) || coalesce(array_to_string(list_transform(string_split(p_type, ' ')[2:], lambda x: upper(x[1]) || lower(x[2:])), ''), '') AS camel,
 regexp_extract(p_brand, '([0-9]+)', 1) AS digits, 'part ' || p_partkey || ': ' || p_brand AS line FROM part""")
def fn_string_case(spark, d):
    return table(spark, d, "part").select("p_partkey", fn["string.snakeCase"](F.col("p_type")).alias("snake"), fn["string.camelCase"](F.col("p_type")).alias("camel"), fn["string.regexExtract"](F.col("p_brand"), "([0-9]+)").alias("digits"), fn["string.format"]("part %v: %v", F.col("p_partkey"), F.col("p_brand")).alias("line"))


@query("""SELECT doc_id, sha256(text) AS s, md5(text) AS m, replace(replace(rtrim(to_base64(encode(text)), '='), '+', '-'), '/', '_') AS b, md5(text) AS back,
 coalesce(nullif(lang, ''), nullif(source, ''), 'none') AS c FROM documents""")
def fn_hash_b64(spark, d):
    t = F.col("text")
    coded = fn["util.base64UrlEncode"](t)
    return table(spark, d, "documents").select("doc_id", fn["util.sha256"](t).alias("s"), fn["util.md5"](t).alias("m"), coded.alias("b"), F.md5(fn["util.base64UrlDecode"](coded)).alias("back"), fn["util.coalesce"](F.col("lang"), F.col("source"), F.lit("none")).alias("c"))


_PADS = ["".join(f"\\x{c ^ x:02X}" for c in b"secret".ljust(64, b"\0")) for x in (0x36, 0x5C)]


@query(f"SELECT c_custkey, sha256('{_PADS[1]}'::BLOB || unhex(sha256('{_PADS[0]}'::BLOB || encode(c_name)))) AS h FROM customer")
def fn_hmac(spark, d):
    return table(spark, d, "customer").select("c_custkey", fn["util.hmacSha256"](F.col("c_name"), "secret").alias("h"))


@query("""WITH RECURSIVE o AS (SELECT o_orderkey, o_orderdate::DATE AS day FROM orders), s AS (SELECT o_orderkey, day, day AS cur, 0 AS n FROM o UNION ALL
  SELECT o_orderkey, day, (cur + 1)::DATE, n + CASE WHEN isodow((cur + 1)::DATE) < 6 THEN 1 ELSE 0 END FROM s WHERE n < 7)
 SELECT o_orderkey, strftime(max(cur) FILTER (n = 7), '%Y-%m-%dT00:00:00Z') AS due, isodow(any_value(day)) >= 6 AS weekend, isodow(any_value(day)) < 6 AS weekday, quarter(any_value(day))::INTEGER AS q,
 epoch_ms(any_value(day)::TIMESTAMP) AS ms, strftime(any_value(day), '%Y-%m-%dT00:00:00Z') AS start, any_value(day) < DATE '1995-06-17' AS early FROM s GROUP BY 1""")
def fn_datetime_business(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    utc = F.concat(day, F.lit("T00:00:00Z"))
    return table(spark, d, "orders").select("o_orderkey", fn["datetime.addBusinessDays"](utc, 7).alias("due"), fn["datetime.isWeekend"](utc).alias("weekend"), fn["datetime.isWeekday"](utc).alias("weekday"), fn["datetime.quarter"](utc).alias("q"), fn["datetime.toEpoch"](utc).alias("ms"), fn["datetime.startOfDay"](utc).alias("start"), fn["datetime.isBefore"](utc, F.lit("1995-06-17T00:00:00Z")).alias("early"))


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, 'x' AS added, event_type AS kind FROM events""")
def fn_json_merge_remove(spark, d):
    m = fn["json.merge"](F.from_json("props", "map<string,string>"), F.create_map(F.lit("added"), F.lit("y"), F.lit("gone"), F.lit("1")), F.create_map(F.lit("added"), F.lit("x"), F.lit("kind"), F.col("event_type")))
    m = fn["json.removeKey"](m, "gone")
    return table(spark, d, "events").select("event_id", m["k"].alias("k"), m["added"].alias("added"), m["kind"].alias("kind"))


def _clean_sql():
    """The clean-up over the pages' texts; RE2's own classes and line ends."""
    t = "regexp_replace(html, '<[^>]*>', chr(10), 'g')"
    for name, char in _text.ENTITIES:
        t = f"replace({t}, '{name}', {'chr(1)' if char == '&' else repr(char) if char != chr(39) else 'chr(39)'})"
    t = f"replace({t}, chr(1), '&')"
    for pattern, by in ((_text.NUMERIC_ENTITY, ""), (r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}]", ""), (_text.IMAGE, ""), (_text.EMAIL, "[email]"), (_text.URL_LINE.replace("(?md)", "(?m)"), ""), (_text.URL_FRAGMENT.replace("(?md)", "(?m)"), "")):
        t = f"regexp_replace({t}, '{pattern}', '{by}', 'g')"
    t = f"array_to_string(list_transform(string_split({t}, chr(10)), lambda x: {_TRIM.format('x')}), chr(10))"
    # lengths are bytes: lines of hexadecimal bytes, joined by the byte of a space
    spaced = f"replace(regexp_replace(hex({t}), '(..)', '\\1 ', 'g'), '0A ', chr(10))"
    short = f"((?:.. ){{1,{_text.SHORT}}})"
    pairs = rf"regexp_replace({spaced}, '(?m)^{short}\n\n{short}$', '\1 20 \2', 'g')"
    t = f"decode(unhex(replace(replace({pairs}, chr(10), '0A '), ' ', '')))"
    return _TRIM.format(rf"regexp_replace({t}, '\n{{3,}}', chr(10) || chr(10), 'g')")


_TRIM = r"regexp_replace(regexp_replace({}, '^[\s\v]+', ''), '[\s\v]+$', '')"


@query(f"SELECT page_id, {_clean_sql()} AS text FROM pages")
def fn_clean_text(spark, d):
    return table(spark, d, "pages").select("page_id", fn["text.cleanText"](F.regexp_replace("html", "<[^>]*>", "\n")).alias("text"))


# vectors --------------------------------------------------------------------------
QUERY = [round(((i * 37) % 64 - 32) / 32, 4) for i in range(64)]
_Q = "[" + ", ".join(map(str, QUERY)) + "]::DOUBLE[]"
_SCORES = {"cosine": f"list_cosine_similarity(embedding::DOUBLE[], {_Q})", "dot": f"list_dot_product(embedding::DOUBLE[], {_Q})", "euclidean": f"1 / (1 + list_distance(embedding::DOUBLE[], {_Q}))"}


def _vectors(spark, d):
    return table(spark, d, "embeddings")


def _topk(metric):
    @query(f"SELECT vec_id, round({_SCORES[metric]}, 6) AS score FROM embeddings ORDER BY {_SCORES[metric]} DESC, vec_id LIMIT 10", f"vector_topk_{metric}")
    def run(spark, d):
        return vectors.vector_search(_vectors(spark, d), QUERY, 10, "vec_id", "embedding", metric).select("vec_id", F.round("score", 6).alias("score"))


for _m in _SCORES:
    _topk(_m)


@query(f"SELECT vec_id, round({_SCORES['cosine']}, 6) AS score FROM embeddings WHERE label IN (1, 2, 3) AND vec_id >= 20 ORDER BY {_SCORES['cosine']} DESC, vec_id LIMIT 15")
def vector_filtered_topk(spark, d):
    return vectors.vector_search(_vectors(spark, d), QUERY, 15, "vec_id", "embedding", filters={"label": {"$in": [1, 2, 3]}, "vec_id": {"$gte": 20}}).select("vec_id", F.round("score", 6).alias("score"))


@query("SELECT vec_id, label FROM embeddings WHERE label <> 0 ORDER BY vec_id LIMIT 50 OFFSET 100")
def vector_scroll_page(spark, d):
    return vectors.scroll(_vectors(spark, d), 50, 100, "vec_id", {"label": {"$ne": 0}}).select("vec_id", "label")


@query("SELECT count(*) AS n FROM embeddings WHERE label NOT IN (0, 1) AND label < 8")
def vector_count_filtered(spark, d):
    return _vectors(spark, d).where(vectors.metadata_filter({"label": {"$nin": [0, 1], "$lt": 8}})).agg(F.count("*").alias("n"))


@query("SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN 99 ELSE label END::INTEGER AS label FROM embeddings UNION ALL SELECT vec_id + 10000000, 98 FROM embeddings WHERE vec_id % 50 = 0")
def vector_upsert(spark, d):
    v = _vectors(spark, d).select("vec_id", "label")
    old = v.where("vec_id % 10 = 0")
    more = old.select("vec_id", F.lit(5).alias("label"), F.lit(1).alias("seq")).unionByName(old.select("vec_id", F.lit(99).alias("label"), F.lit(2).alias("seq"))).unionByName(v.where("vec_id % 50 = 0").select((F.col("vec_id") + 10_000_000).alias("vec_id"), F.lit(98).alias("label"), F.lit(1).alias("seq")))
    return vectors.upsert(v, more, "vec_id", "seq")


@query("SELECT vec_id, label FROM embeddings WHERE label <> 3")
def vector_delete_filtered(spark, d):
    return vectors.delete(_vectors(spark, d).select("vec_id", "label"), "vec_id", filters={"label": 3})


@query(f"""WITH v AS (SELECT vec_id AS id, {_SCORES['cosine']} AS s FROM embeddings ORDER BY s DESC, id LIMIT 100), t AS (SELECT vec_id AS id, {_SCORES['dot']} AS s FROM embeddings WHERE label < 5 ORDER BY s DESC, id LIMIT 100),
 a AS (SELECT id, row_number() OVER (ORDER BY s DESC, id) AS r FROM v), b AS (SELECT id, row_number() OVER (ORDER BY s DESC, id) AS r FROM t)
 SELECT coalesce(a.id, b.id) AS vec_id, round(coalesce(0.7 / (60 + a.r), 0) + coalesce((1 - 0.7) / (60 + b.r), 0), 8) AS score FROM a FULL JOIN b ON a.id = b.id ORDER BY coalesce(0.7 / (60 + a.r), 0) + coalesce((1 - 0.7) / (60 + b.r), 0) DESC, 1 LIMIT 10""")
def hybrid_rrf(spark, d):
    n, v = vectors.candidates(10), _vectors(spark, d)
    a = vectors.vector_search(v, QUERY, n, "vec_id", "embedding").select("vec_id", "score")
    b = vectors.vector_search(v, QUERY, n, "vec_id", "embedding", "dot", {"label": {"$lt": 5}}).select("vec_id", "score")
    return vectors.rrf(a, b, 10, 0.7, "vec_id").select("vec_id", F.round("score", 8).alias("score"))


@query(r"""WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: TRUE) AS w FROM documents),
 c AS (SELECT doc_id, len(w) AS n, len(list_filter(w, lambda x: x = 'the')) AS t0, len(list_filter(w, lambda x: x = 'license')) AS t1 FROM t),
 s AS (SELECT count(*) AS docs, avg(n) AS mean, sum((t0 > 0)::INT) AS d0, sum((t1 > 0)::INT) AS d1 FROM c)
 SELECT doc_id, round(ln(1 + (docs - d0 + 0.5) / (d0 + 0.5)) * t0 * 2.2 / (t0 + 1.2 * (0.25 + 0.75 * n / mean)) + ln(1 + (docs - d1 + 0.5) / (d1 + 0.5)) * t1 * 2.2 / (t1 + 1.2 * (0.25 + 0.75 * n / mean)), 5) AS score FROM c, s WHERE t0 > 0 OR t1 > 0""")
def text_bm25(spark, d):
    return vectors.text_scores(table(spark, d, "documents"), ["the", "license"], "doc_id", "text").select("doc_id", F.round("score", 5).alias("score"))


_FIVE = f"SELECT vec_id, 'label ' || label AS content, {_SCORES['cosine']} AS score FROM embeddings ORDER BY score DESC, vec_id LIMIT 5"


@query(f"""SELECT string_agg('[' || r || '] (score: ' || printf('%.4f', score) || ')' || chr(10) || content, chr(10) || chr(10) ORDER BY r) AS context
 FROM (SELECT *, row_number() OVER (ORDER BY score DESC, vec_id) AS r FROM ({_FIVE}))""")
def rag_context(spark, d):
    hits = vectors.vector_search(_vectors(spark, d).withColumn("content", F.concat(F.lit("label "), F.col("label").cast("string"))), QUERY, 5, "vec_id", "embedding")
    return vectors.format_context(hits, "numbered", "vec_id")


@query("""SELECT TRUE AS found, label FROM embeddings WHERE vec_id = 17 UNION ALL SELECT FALSE, NULL::INTEGER""")
def vector_get_document(spark, d):
    v = _vectors(spark, d)
    return vectors.get_document(v, 17, "vec_id").unionByName(vectors.get_document(v, -1, "vec_id")).select("found", "label")


@query("""SELECT (SELECT array_to_string(list(vec_id::VARCHAR ORDER BY vec_id), ',') FROM (SELECT vec_id FROM embeddings WHERE label < 3 ORDER BY 1 LIMIT 40 OFFSET 20)) AS ids,
 CASE WHEN count(*) > 60 THEN 60 END::INTEGER AS next_offset, count(*) AS total FROM embeddings WHERE label < 3""")
def vector_scroll_total(spark, d):
    page = vectors.scroll_page(_vectors(spark, d), 40, 20, "vec_id", {"label": {"$lt": 3}}, without=("embedding",))
    return page.select(F.array_join(F.transform("documents", lambda r: r.vec_id.cast("string")), ",").alias("ids"), "next_offset", "total")


@query("SELECT vec_id FROM embeddings WHERE vec_id > 100 ORDER BY 1 LIMIT 25")
def vector_scroll_after(spark, d):
    return vectors.scroll(_vectors(spark, d), 25, id_col="vec_id", after=100, without=("embedding", "label"))


@query(f"""WITH v AS (SELECT vec_id AS id, {_SCORES['cosine']} AS s FROM embeddings ORDER BY s DESC, id LIMIT 100), t AS (SELECT vec_id AS id, {_SCORES['euclidean']} AS s FROM embeddings WHERE label < 5 ORDER BY s DESC, id LIMIT 100)
 SELECT coalesce(v.id, t.id) AS vec_id, round(0.6 * coalesce(v.s, 0) + 0.4 * coalesce(t.s, 0), 6) AS score FROM v FULL JOIN t ON v.id = t.id ORDER BY 0.6 * coalesce(v.s, 0) + 0.4 * coalesce(t.s, 0) DESC, 1 LIMIT 10""")
def hybrid_weighted(spark, d):
    n, v = vectors.candidates(10), _vectors(spark, d)
    a = vectors.vector_search(v, QUERY, n, "vec_id", "embedding").select("vec_id", "score")
    b = vectors.vector_search(v, QUERY, n, "vec_id", "embedding", "euclidean", {"label": {"$lt": 5}}).select("vec_id", "score")
    return vectors.weighted(a, b, 10, 0.6, "vec_id").select("vec_id", F.round("score", 6).alias("score"))


def _said(spark, d):
    return _vectors(spark, d).withColumn("said", F.concat_ws(" ", F.lit("label"), F.col("label").cast("string")))


@query(f"SELECT vec_id, round({_SCORES['cosine']}, 6) AS score, 'text search is not supported; dense results' AS fallback_reason FROM embeddings ORDER BY {_SCORES['cosine']} DESC, vec_id LIMIT 10")
def hybrid_dense_fallback(spark, d):
    out = vectors.hybrid(_said(spark, d), QUERY, ["3"], 10, mode="dense", id_col="vec_id", vector="embedding", text="said")
    return out.select("vec_id", F.round("score", 6).alias("score"), "fallback_reason")


@query(f"SELECT vec_id, round({_SCORES['dot']}, 6) AS score, '' AS fallback_reason FROM embeddings WHERE label = 3 OR label = 5 ORDER BY {_SCORES['dot']} DESC, vec_id LIMIT 10")
def hybrid_text_prefilter(spark, d):
    out = vectors.hybrid(_said(spark, d), QUERY, ["3", "5"], 10, mode="prefilter", id_col="vec_id", vector="embedding", text="said", metric="dot")
    return out.select("vec_id", F.round("score", 6).alias("score"), "fallback_reason")


@query("""WITH w AS (SELECT p_partkey, unnest(string_split(lower(p_name || ' ' || p_type), ' ')) AS w FROM part), h AS (SELECT p_partkey,
  list_reduce(list_prepend(2166136261, list_transform(range(0, length(hex(w)), 2), lambda i: ('0x' || substr(hex(w), i + 1, 2))::BIGINT)), lambda a, b: xor(a, b) * 16777619 % 4294967296) AS i FROM w WHERE w <> ''),
 c AS (SELECT p_partkey, i, count(*) AS n FROM h GROUP BY ALL)
 SELECT p_partkey, array_to_string(list(i::VARCHAR ORDER BY i), ',') AS indices, round(max(n) / sum(n), 5) AS top FROM c GROUP BY 1""")
def vector_sparse(spark, d):
    v = table(spark, d, "part").select("p_partkey", vectors.sparse_vector(F.concat_ws(" ", "p_name", "p_type")).alias("v"))
    return v.select("p_partkey", F.array_join(F.transform("v.indices", lambda i: i.cast("string")), ",").alias("indices"), F.round(F.array_max("v.values").cast("double"), 5).alias("top"))


@query("""WITH s AS (SELECT c_custkey, ((CASE WHEN list_contains(string_split(lower(c_mktsegment), ' '), 'building') THEN 1 ELSE 0 END) + (CASE WHEN c_nationkey = 7 THEN 1 ELSE 0 END)) / 2.0 AS score FROM customer)
 SELECT c_custkey, score::DOUBLE AS rerank_score, row_number() OVER (ORDER BY score DESC, c_custkey)::INTEGER AS rank FROM s ORDER BY rank LIMIT 20""")
def rerank_overlap(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.concat_ws(" ", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("content"))
    return models.rerank(c, "BUILDING 7", models.OverlapScorer(), 20, id_col="c_custkey").select("c_custkey", "rerank_score", "rank")


# chunks ---------------------------------------------------------------------------
@query(r"""WITH c AS (SELECT doc_id, length(text) AS n, text, unnest(CASE WHEN length(text) <= 1000 THEN [0] ELSE range(0, (ceil((length(text) - 1000) / 900.0)::BIGINT * 900 + 1)::BIGINT, 900) END) AS i FROM documents),
 p AS (SELECT doc_id, i, CASE WHEN n <= 1000 THEN text ELSE trim(text[i + 1:i + 1000], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) END AS chunk, n FROM c),
 k AS (SELECT * FROM p WHERE n <= 1000 OR chunk <> '')
 SELECT doc_id::VARCHAR || '-chunk-' || (row_number() OVER w - 1) AS chunk_id, (row_number() OVER w - 1)::INTEGER AS chunk_index, md5(chunk) AS chunk_md5 FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY i)""")
def chunk_fixed_overlap(spark, d):
    return chunks.chunk(table(spark, d, "documents"), "fixed", "doc_id", "text", 1000, 100).select("chunk_id", "chunk_index", F.md5("chunk").alias("chunk_md5"))


_SEP = "chr(1)"
_LINES = "replace(text, chr(13) || chr(10), chr(10))"
_SPLIT = {
    "paragraph": f"string_split({_LINES}, chr(10) || chr(10))",
    "heading": f"string_split(regexp_replace({_LINES}, '(^|\\n)(#{{1,6}}\\s)', '\\1' || {_SEP} || '\\2', 'g'), {_SEP})",
    "sentence": f"string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || {_SEP}, 'g'), {_SEP})",
}
_SPLIT = {k: v.replace("\\\\", "\\") for k, v in _SPLIT.items()}


def _chunk_sql(strategy):
    """Split, trim, drop blanks; sentences are gathered to 1000 bytes; parts over
    the cap are cut again."""
    solid = f"list_filter(list_transform({_SPLIT[strategy]}, lambda x: {_TRIM.format('x')}), lambda x: x <> '')"
    parts = f"CASE WHEN len({solid}) = 0 THEN [text] ELSE {solid} END"
    if strategy == "sentence":
        last = f"list_extract(string_split(a, {_SEP}), -1)"
        parts = f"CASE WHEN len({solid}) = 0 THEN [text] ELSE string_split(list_reduce({solid}, lambda a, b: CASE WHEN strlen({last}) + 1 + strlen(b) <= 1000 THEN a || ' ' || b ELSE a || {_SEP} || b END), {_SEP}) END"
    cut = f"list_filter(list_transform(range(0, length(p), 3500), lambda i: {_TRIM.format('p[i + 1:i + 3500]')}), lambda x: x <> '')"
    return f"""WITH s AS (SELECT doc_id, {parts} AS ps FROM documents WHERE text IS NOT NULL), c AS (SELECT doc_id,
  flatten(list_transform(ps, lambda p: CASE WHEN length(p) <= 3500 THEN [p] ELSE {cut} END)) AS k FROM s)
 SELECT doc_id::VARCHAR || '-chunk-' || i AS chunk_id, len(k)::INTEGER AS chunk_total, md5(k[i + 1]) AS chunk_md5 FROM (SELECT doc_id, k, unnest(range(0, len(k))) AS i FROM c)"""


def _chunk(strategy, size=1000):
    @query(_chunk_sql(strategy), f"chunk_{strategy}")
    def run(spark, d):
        return chunks.chunk(table(spark, d, "documents"), strategy, "doc_id", "text", size).select("chunk_id", "chunk_total", F.md5("chunk").alias("chunk_md5"))


for _s in ("paragraph", "sentence", "heading"):
    _chunk(_s)


# rules, changes, logs -------------------------------------------------------------
RULES = [
    {"id": "high-k", "severity": "WARNING", "message": "k is {{.k}}", "match": {"type": "greater_than", "path": "k", "value": 90}},
    {"id": "bad-user", "severity": "ERROR", "message": "user {{.user}}", "when": {"type": "equals", "path": "type", "value": "error"}, "match": {"type": "all_of", "conditions": [{"type": "exists", "path": "user"}, {"type": "not_equals", "path": "user", "value": "7"}]}},
    {"id": "click", "severity": "GOOD", "message": "clicked", "match": {"type": "any_of", "conditions": [{"type": "equals", "path": "type", "value": "click"}, {"type": "regex", "path": "type", "pattern": "^pur"}]}},
    {"id": "no-note", "severity": "INFO", "message": "note missing", "match": {"type": "missing", "path": "note"}},
]
_FINDINGS = """WITH e AS (SELECT event_id, user_id::VARCHAR AS u, event_type AS t, json_extract_string(props, '$.k') AS k FROM events), f AS (
 SELECT event_id, 'high-k' AS rule_id, 'WARNING' AS severity, 'k is ' || k AS message FROM e WHERE k::DOUBLE > 90 UNION ALL
 SELECT event_id, 'high-k', 'INFO', 'rule high-k could not be evaluated' FROM e WHERE k IS NULL UNION ALL
 SELECT event_id, 'bad-user', 'ERROR', 'user ' || u FROM e WHERE t = 'error' AND u <> '7' UNION ALL
 SELECT event_id, 'click', 'GOOD', 'clicked' FROM e WHERE t = 'click' OR t LIKE 'pur%' UNION ALL SELECT event_id, 'no-note', 'INFO', 'note missing' FROM e) """


def _findings(spark, d):
    doc = F.to_json(F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"), F.col("user_id").alias("user"), F.col("event_type").alias("type")))
    return rules.evaluate(table(spark, d, "events").select("event_id", doc.alias("doc")), RULES, "event_id", "doc")


@query(_FINDINGS + "SELECT * FROM f")
def rules_findings(spark, d):
    return _findings(spark, d)


@query(_FINDINGS + "SELECT severity, count(*) AS findings FROM f GROUP BY 1")
def rules_severity_counts(spark, d):
    return rules.severity_counts(_findings(spark, d))


@query(_FINDINGS + """, r AS (SELECT event_id, count(*) FILTER (severity = 'ERROR') AS errors, count(*) FILTER (severity = 'WARNING') AS warnings, count(*) FILTER (severity = 'INFO') AS infos,
  string_agg('| ' || severity || ' | ' || rule_id || ' | ' || replace(message, '|', '\\|') || ' |' || chr(10), '' ORDER BY CASE severity WHEN 'ERROR' THEN 1 WHEN 'WARNING' THEN 2 ELSE 3 END, rule_id) FILTER (severity <> 'GOOD') AS bad,
  string_agg('- **' || rule_id || '** \u2014 ' || message || chr(10), '' ORDER BY rule_id) FILTER (severity = 'GOOD') AS good FROM f GROUP BY 1)
 SELECT event_id, errors, warnings, infos, '## Analysis Report \u2014 ' || event_id || chr(10) || chr(10) || '**Errors:** ' || errors || '  |  **Warnings:** ' || warnings || '  |  **Info:** ' || infos || chr(10) || chr(10)
  || CASE WHEN bad IS NULL THEN '' ELSE '### Findings' || chr(10) || chr(10) || '| Severity | Rule | Message |' || chr(10) || '|----------|------|---------|' || chr(10) || bad || chr(10) END
  || CASE WHEN good IS NULL THEN '' ELSE '### Strengths' || chr(10) || chr(10) || good END AS report FROM r""".replace("\\\\", "\\"))
def rules_report(spark, d):
    return rules.report(table(spark, d, "events"), _findings(spark, d), "event_id")


MATCHES = [
    {"id": "any", "severity": "INFO", "match": {"type": "contains_any", "path": "type", "values": ["lic", "urch"]}},
    {"id": "lack", "severity": "INFO", "match": {"type": "not_contains", "path": "type", "value": "i"}},
    {"id": "named", "severity": "INFO", "match": {"type": "regex_not_match", "path": "type", "pattern": "^[a-m]", "requires_contains": "I"}},
    {"id": "none", "severity": "INFO", "match": {"type": "all_missing", "paths": ["odd", "note"]}},
    {"id": "few", "severity": "INFO", "match": {"type": "less_than", "path": "user", "value": 20}},
    {"id": "twice", "severity": "INFO", "match": {"type": "duplicate_values", "path": "list"}},
    {"id": "long", "severity": "INFO", "match": {"type": "count_exceeds", "path": "list", "value": 2}},
    {"id": "clean", "severity": "INFO", "match": {"type": "none_contain", "path": "head", "keys": ["authorization"]}},
    {"id": "secret", "severity": "INFO", "match": {"type": "credential_header_literal", "path": "head"}},
    {"id": "item", "severity": "INFO", "scope": "list", "message": "{{.}}", "match": {"type": "equals", "value": "3"}},
    {"id": "not", "severity": "INFO", "match": {"type": "none_of", "conditions": [{"type": "contains", "path": "type", "value": "e"}, {"type": "exists", "path": "odd"}]}},
]


@query("""WITH e AS (SELECT event_id, user_id AS u, event_type AS t, event_id % 2 = 1 AS odd FROM events)
 SELECT event_id, 'any' AS rule_id FROM e WHERE contains(t, 'lic') OR contains(t, 'urch') UNION ALL SELECT event_id, 'lack' FROM e WHERE NOT contains(t, 'i')
 UNION ALL SELECT event_id, 'named' FROM e WHERE contains(lower(t), 'i') AND NOT regexp_matches(t, '^[a-m]') UNION ALL SELECT event_id, 'none' FROM e WHERE NOT odd
 UNION ALL SELECT event_id, 'few' FROM e WHERE u < 20 UNION ALL SELECT event_id, 'twice' FROM e WHERE u % 4 = event_id % 5 OR event_id % 5 = 3 OR u % 4 = 3
 UNION ALL SELECT event_id, 'long' FROM e UNION ALL SELECT event_id, 'clean' FROM e WHERE odd UNION ALL SELECT event_id, 'secret' FROM e WHERE NOT odd AND u % 3 > 0
 UNION ALL SELECT event_id, 'item' FROM e WHERE u % 4 = 3 UNION ALL SELECT event_id, 'item' FROM e WHERE event_id % 5 = 3 UNION ALL SELECT event_id, 'item' FROM e
 UNION ALL SELECT event_id, 'not' FROM e WHERE NOT contains(t, 'e') AND NOT odd""")
def rules_match_types(spark, d):
    odd = F.col("event_id") % 2 == 1
    token = F.when(F.col("user_id") % 3 == 0, "=$property").otherwise("Bearer x")
    head = F.when(odd, F.create_map(F.lit("Accept"), F.lit("*"))).otherwise(F.create_map(F.lit("Authorization"), token))
    doc = F.to_json(F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"), F.when(odd, 1).alias("odd"), F.array(F.col("user_id") % 4, F.col("event_id") % 5, F.lit(3)).alias("list"), head.alias("head")))
    return rules.evaluate(table(spark, d, "events").select("event_id", doc.alias("doc")), MATCHES, "event_id", "doc").select("event_id", "rule_id")


@query("""SELECT c_custkey, 'name=' || c_name || ';balance=' || c_custkey || ';' AS held, 2::INTEGER AS size FROM customer""")
def rules_key_values(spark, d):
    text = F.concat(F.lit("# a note\n\nbalance = none\nname="), "c_name", F.lit("\r\nbalance= "), F.col("c_custkey").cast("string"))
    c = table(spark, d, "customer").select("c_custkey", rules.key_values(text).alias("m"))
    return c.select("c_custkey", F.concat(F.lit("name="), F.col("m.name"), F.lit(";balance="), F.col("m.balance"), F.lit(";")).alias("held"), F.size("m").alias("size"))


@query("SELECT doc_id, n AS line_no, line FROM (SELECT doc_id, unnest(string_split_regex(text, '\\r?\\n')) AS line, generate_subscripts(string_split_regex(text, '\\r?\\n'), 1)::INTEGER AS n FROM documents WHERE text IS NOT NULL)".replace("\\\\", "\\"))
def rules_document_lines(spark, d):
    return rules.document_lines(table(spark, d, "documents"), "doc_id", "text")


@query("""SELECT c_custkey, '{"host.name":"h1","name":"' || c_name || '","service.name":"' || c_mktsegment || '"}' AS line FROM customer WHERE c_custkey % 2 = 0
 UNION ALL SELECT c_custkey, '{"host.name":"h1","name":"' || c_name || '","service.name":"shop"}' FROM customer WHERE c_custkey % 2 = 1""")
def log_ecs_json(spark, d):
    held = F.create_map(F.lit("name"), F.col("c_name"), F.lit("service.name"), F.col("c_mktsegment"))
    m = F.when(F.col("c_custkey") % 2 == 0, held).otherwise(F.map_filter(held, lambda k, _: k == "name"))
    return table(spark, d, "customer").select("c_custkey", shaping.json_line(shaping.ecs(m, "shop", "h1")).alias("line"))


@query("SELECT p_partkey, 'a' || p_size || ',name' AS used FROM part")
def template_variables(spark, d):
    size = F.col("p_size").cast("string")
    text = F.concat(F.lit("{{a"), size, F.lit("}} and {{ .name }}, {{.a"), size, F.lit("}} {{name}}"))
    return table(spark, d, "part").select("p_partkey", F.array_join(shaping.used_variables(text), ",").alias("used"))


@query("SELECT event_id, user_id AS user, event_type AS kind, TRUE AS good FROM events WHERE event_id % 5 > 0 UNION ALL SELECT event_id, NULL, NULL, FALSE FROM events WHERE event_id % 5 = 0")
def json_decode_quarantine(spark, d):
    message = F.when(F.col("event_id") % 5 > 0, F.to_json(F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("kind")))).otherwise(F.concat(F.lit('{"user": '), "event_type"))
    good, bad = decode_json(table(spark, d, "events").select("event_id", message.alias("value")), "user bigint, kind string")
    return good.withColumn("good", F.lit(True)).unionByName(bad.select("event_id").withColumn("good", F.lit(False)), allowMissingColumns=True)


@query("SELECT o_orderkey::VARCHAR AS event_id, 'UPDATE' AS event_type, o_orderstatus AS status, o_orderpriority AS was FROM orders WHERE o_orderkey % 4 > 0 UNION ALL SELECT NULL, 'bad', NULL, NULL FROM orders WHERE o_orderkey % 4 = 0")
def cdc_decode(spark, d):
    sent = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("event_id"), F.lit("UPDATE").alias("event_type"), F.create_map(F.lit("status"), "o_orderstatus").alias("data"), F.create_map(F.lit("status"), "o_orderpriority").alias("old_data")))
    payload = F.when(F.col("o_orderkey") % 4 > 0, sent).otherwise(F.lit("{"))
    good, bad = changes.decode(table(spark, d, "orders").select(payload.alias("value")), "value")
    told = good.select("event_id", "event_type", F.col("data.status").alias("status"), F.col("old_data.status").alias("was"))
    return told.unionByName(bad.select(F.lit("bad").alias("event_type")), allowMissingColumns=True)


@query("""SELECT event_id, unnest(CASE WHEN value > 80 THEN ['high', 'rest', 'evalError'] ELSE ['rest', 'evalError'] END) AS route FROM events""")
def split_eval_error(spark, d):
    routes = [Route("broken", (Predicate("event_type", "gt", "1"),)), Route("high", (Predicate("value", "gt", "80"),), priority=1), Route("rest", priority=2)]
    return predicates.split(table(spark, d, "events"), routes, first_match=False).select("event_id", "route")


@query("SELECT event_id, TRUE AS empty FROM events UNION ALL SELECT event_id, FALSE FROM events WHERE event_id % 3 = 0 OR value > 60")
def filter_empty_and_missing(spark, d):
    e = table(spark, d, "events").withColumn("maybe", F.when(F.col("event_id") % 3 > 0, F.col("value")))
    lenient = predicates.filter_rows(e, [Predicate("maybe", "gt", "60")], pass_missing=True)
    return predicates.filter_rows(e, []).select("event_id", F.lit(True).alias("empty")).unionByName(lenient.select("event_id", F.lit(False).alias("empty")))


@query("SELECT o_orderkey, o_orderdate > TIMESTAMP '1996-01-01' AS late, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS again FROM orders")
def fn_datetime_epoch(spark, d):
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return table(spark, d, "orders").select("o_orderkey", fn["datetime.isAfter"](text, F.lit("1996-01-01T00:00:00Z")).alias("late"), fn["datetime.fromEpoch"](fn["datetime.toEpoch"](text)).alias("again"))


def _context(style, shape, between="chr(10) || chr(10)"):
    @query(f"""SELECT string_agg({shape}, {between} ORDER BY r) AS context FROM (SELECT *, row_number() OVER (ORDER BY score DESC, vec_id) AS r FROM ({_FIVE}))""", f"rag_context_{style}")
    def run(spark, d):
        hits = vectors.vector_search(_vectors(spark, d).withColumn("content", F.concat(F.lit("label "), F.col("label").cast("string"))), QUERY, 5, "vec_id", "embedding")
        return vectors.format_context(hits, style, "vec_id")


_context("markdown", "'### Result ' || r || ' (score: ' || printf('%.4f', score) || ')' || chr(10) || chr(10) || content")
_context("plain", "content")
_context("xml", "'<document index=\"' || r || '\" score=\"' || printf('%.4f', score) || '\">' || chr(10) || content || chr(10) || '</document>'")


@query("""SELECT p_partkey, 'user.name=' || p_name || '|user.kind=' || p_type || '|sizes=[' || p_size || ',' || p_size + 1 || ']|brand=' || p_brand AS line FROM part""")
def log_flatten(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.struct(F.col("p_name").alias("name"), F.col("p_type").alias("kind")).alias("user"), F.array("p_size", F.col("p_size") + 1).alias("sizes"), F.col("p_brand").alias("brand"))
    m = shaping.flatten(p.drop("p_partkey"))
    return p.select("p_partkey", F.array_join(F.transform(F.map_entries(m), lambda e: F.concat_ws("=", e.key, e.value)), "|").alias("line"))


@query("""SELECT event_id, 'id: ' || event_id || chr(10) || CASE WHEN event_type = 'click' THEN '' ELSE 'event: ' || event_type || chr(10) END || 'retry: 500' || chr(10) || 'data: ' || props || chr(10) || chr(10) AS wire FROM events""")
def sse_wire(spark, d):
    kind = F.when(F.col("event_type") == "click", "message").otherwise(F.col("event_type"))
    return table(spark, d, "events").select("event_id", shaping.sse_event(F.col("props"), kind, F.col("event_id"), 500).alias("wire"))


@query("""SELECT p_partkey, left(p_name, 4) || '...' || ' ' || replace(p_brand, 'Brand', 'B') || ' ' || contains(p_type, 'A') || ' ' || (p_size + 1) || ' ' || (p_size - 1) || ' ' || p_size * 2 || ' ' || p_size // 3 || ' 0 '
 || list_extract(string_split(p_type, ' '), 1) || ' ' || list_extract(string_split(p_type, ' '), -1) || ' ' || array_to_string(list_sort(string_split(p_type, ' ')), '+') || ' ' || (p_size = 7) || ' ' || (p_size <> 7) || ' '
 || (p_size < 7) || ' ' || (p_size > 7) || ' ' || (p_size <= 7) || ' ' || (p_size >= 7) || ' none "' || p_brand || '" 2024/03' || ' ' || strlen(p_name) AS text FROM part""")
def template_functions(spark, d):
    t = (
        '{{truncate 4 .name}} {{replace "Brand" "B" .brand}} {{contains .type "A"}} {{add .size 1}} {{subtract .size 1}} {{multiply .size 2}} {{divide .size 3}} {{divide .size 0}} {{split .type " " | first}} {{last (x)}}'
        ' {{split .type " " | sort | joined}} {{eq .size 7}} {{ne .size 7}} {{lt .size 7}} {{gt .size 7}} {{le .size 7}} {{ge .size 7}} {{default "none" .missing}} {{json .brand}} {{formatDate "2006/01" .date}} {{length .name}}'
    ).replace("{{last (x)}}", "{{last .parts}}").replace('{{split .type " " | sort | joined}}', '{{join .sorted "+"}}')
    parts = F.split("p_type", " ")
    fields = {"name": F.col("p_name"), "brand": F.col("p_brand"), "type": F.col("p_type"), "size": F.col("p_size"), "date": F.lit("2024-03-09T10:00:00Z"), "parts": parts, "sorted": F.array_sort(parts)}
    return table(spark, d, "part").select("p_partkey", shaping.render(t, fields, ("parts", "sorted")).alias("text"))


@query(r"""WITH l AS (SELECT page_id, list_transform(string_split(html, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))) AS l, html FROM pages)
 SELECT page_id, len(list_filter(l, lambda x: ends_with(x, ':') AND strlen(x) > 1))::INTEGER AS sections, len(list_filter(l, lambda x: x = ''))::INTEGER AS empty_lines,
 CASE WHEN starts_with(trim(html), '<') AND ends_with(trim(html, ' ' || chr(10)), '>') THEN 'application/xml' WHEN contains(html, '<html>') OR contains(html, '<!DOCTYPE') THEN 'text/html' WHEN contains(html, 'Subject:') THEN 'message/rfc822'
  WHEN contains(html, '# ') OR contains(html, '- ') OR contains(html, '* ') THEN 'text/markdown' ELSE 'text/plain' END AS kind FROM l""")
def content_analysis(spark, d):
    t = F.col("html")
    return table(spark, d, "pages").withColumn("f", shaping.content_flags(t)).select("page_id", "f.sections", "f.empty_lines", shaping.content_type(t).alias("kind"))


_CHANGES = """WITH c AS (SELECT o_orderkey, 1 AS seq, 2 AS op, o_totalprice AS price FROM orders UNION ALL SELECT o_orderkey, 2, 3, o_totalprice FROM orders WHERE o_orderkey % 3 = 0
 UNION ALL SELECT o_orderkey, 2, 4, o_totalprice + 1 FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey, 3, 1, o_totalprice FROM orders WHERE o_orderkey % 7 = 0) """


def _change_rows(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    row = lambda df, seq, op, price="price": df.select("o_orderkey", F.lit(seq).alias("seq"), F.lit(op).alias("op"), F.expr(price).alias("price"))
    third = o.where("o_orderkey % 3 = 0")
    return row(o, 1, 2).unionByName(row(third, 2, 3)).unionByName(row(third, 2, 4, "price + 1")).unionByName(row(o.where("o_orderkey % 7 = 0"), 3, 1))


@query(_CHANGES + """SELECT c.o_orderkey, c.seq, CASE c.op WHEN 1 THEN 'DELETE' WHEN 2 THEN 'INSERT' ELSE 'UPDATE' END AS event_type, c.price, b.price AS old_price
 FROM c LEFT JOIN c b ON c.op = 4 AND b.op = 3 AND b.o_orderkey = c.o_orderkey WHERE c.op <> 3""")
def cdc_pair_updates(spark, d):
    return changes.pair_updates(_change_rows(spark, d), ["seq"], "op", ["price"], ["o_orderkey"])


@query("SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS price FROM orders WHERE o_orderkey % 7 <> 0")
def cdc_apply_changes(spark, d):
    events = changes.pair_updates(_change_rows(spark, d), ["seq"], "op", ["price"], ["o_orderkey"])
    return changes.apply_changes(table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price")), events, "o_orderkey", "seq")


def _fields():
    return F.create_map(F.lit("user.name"), F.col("c_name"), F.lit("user.segment"), F.col("c_mktsegment"), F.lit("balance"), F.col("c_acctbal").cast("decimal(12,2)").cast("string"), F.lit("key"), F.col("c_custkey").cast("string"))


@query("SELECT c_custkey, 'balance=*** user.name=' || left(c_name, 0) || '***' || ' user.segment=***' AS line FROM customer")
def log_mask_wildcard(spark, d):
    m = shaping.select_fields(_fields(), include=["user.*", "bal*"])
    return table(spark, d, "customer").select("c_custkey", shaping.key_value(shaping.mask_fields(m, ["BALANCE", "user.*"])).alias("line"))


@query("""SELECT c_custkey, 'balance=' || c_acctbal::DECIMAL(12,2)::VARCHAR || ' key=' || c_custkey || ' user.name=' || CASE WHEN regexp_matches(c_name, '\\s') OR c_name = '' THEN '"' || c_name || '"' ELSE c_name END
 || ' user.segment=' || c_mktsegment AS line FROM customer""".replace("\\\\", "\\"))
def logfmt_line(spark, d):
    return table(spark, d, "customer").select("c_custkey", shaping.logfmt(_fields()).alias("line"))


@query("SELECT c_custkey, 'Dear ' || upper(c_name) || ', ' || c_mktsegment || '.' AS text FROM customer")
def template_render(spark, d):
    return table(spark, d, "customer").select("c_custkey", shaping.render("Dear {{upper .name}}, {{segment}}.{{none}}", {"name": F.col("c_name"), "segment": F.col("c_mktsegment")}).alias("text"))


@query("SELECT o_orderkey, CASE WHEN floor(o_totalprice) > 100000 AND o_orderstatus = 'O' THEN '<o s=\"' || o_orderstatus || '\"><p>' || floor(o_totalprice)::BIGINT || '</p></o>' ELSE '' END AS xml FROM orders")
def xml_filter(spark, d):
    o = table(spark, d, "orders")
    xml = F.concat(F.lit('<o s="'), "o_orderstatus", F.lit('"><p>'), F.expr("cast(floor(o_totalprice) as bigint)").cast("string"), F.lit("</p></o>"))
    return o.select("o_orderkey", shaping.xml_filter(xml, ["/o[@s='O']", "/o/p[. > 100000]"]).alias("xml"))


# relational -----------------------------------------------------------------------
@query("""SELECT n_name, o_orderpriority, sum((l_extendedprice * (1 - l_discount))::DECIMAL(18,4))::DOUBLE AS revenue, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey WHERE l_shipdate >= TIMESTAMP '1995-01-01' GROUP BY ALL""")
def rel_star_join(spark, d):
    l, o, c, n = (table(spark, d, t) for t in ("lineitem", "orders", "customer", "nation"))
    rows = l.where("l_shipdate >= timestamp_ntz'1995-01-01 00:00:00'").join(o, l.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return rows.groupBy("n_name", "o_orderpriority").agg(F.sum((F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")).cast("double").alias("revenue"), F.count("*").alias("n"))


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 250000)")
def rel_semi_anti(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return c.join(o.where("o_orderstatus = 'F'"), "c_custkey", "left_semi").join(o.where("o_totalprice > 250000"), "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS q, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def rel_rollup(spark, d):
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("q"), F.count("*").alias("n"))


@query("SELECT p_brand, p_size, count(*) AS n, sum(p_retailprice::DECIMAL(12,2))::DOUBLE AS price FROM part GROUP BY CUBE (p_brand, p_size)")
def rel_cube(spark, d):
    return table(spark, d, "part").cube("p_brand", "p_size").agg(F.count("*").alias("n"), F.sum(F.col("p_retailprice").cast("decimal(12,2)")).cast("double").alias("price"))


@query("SELECT o_custkey, o_orderkey, rank FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INTEGER AS rank FROM orders) WHERE rank <= 3")
def rel_rank_topk(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", F.row_number().over(w).alias("rank")).where("rank <= 3")


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey = 0")
def rel_set_ops(spark, d):
    c, s, n = (table(spark, d, t) for t in ("customer", "supplier", "nation"))
    return c.select(F.col("c_nationkey").alias("k")).union(s.select("s_nationkey")).distinct().exceptAll(n.where("n_regionkey = 0").select("n_nationkey"))


@query("SELECT c_custkey, count(o_orderkey) AS orders, coalesce(max(o_totalprice), 0) AS top FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def rel_left_join(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("top"))  # before the join: fewer rows meet
    return table(spark, d, "customer").select("c_custkey").join(o, "c_custkey", "left").select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"), F.coalesce("top", F.lit(0.0)).alias("top"))


@query("SELECT coalesce(c_nationkey, s_nationkey) AS k, coalesce(c, 0) AS customers, coalesce(s, 0) AS suppliers FROM (SELECT c_nationkey, count(*) AS c FROM customer GROUP BY 1) FULL JOIN (SELECT s_nationkey, count(*) AS s FROM supplier GROUP BY 1) ON c_nationkey = s_nationkey")
def rel_full_join(spark, d):
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers"))
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    return c.join(s, "k", "full_outer").na.fill(0)


@query("SELECT a.event_id, b.event_id AS next_id FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'view' AND b.event_type = 'purchase' AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 1 HOUR")
def rel_interval_join(spark, d):
    """Buckets of an hour make the interval an equality: each left row meets its
    own bucket and the next, so a hot user is spread over hours."""
    return joins.interval_join(table(spark, d, "events").where("event_type = 'view'").select("event_id", "user_id", "ts"), table(spark, d, "events").where("event_type = 'purchase'").select(F.col("event_id").alias("next_id"), "user_id", "ts"), ["user_id"], "ts", "ts", 3600).select("event_id", "next_id")


@query("SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n, sum(l_quantity)::DOUBLE AS q FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linenumber), ())")
def rel_grouping_sets(spark, d):
    sets = [[F.col("l_returnflag"), F.col("l_linestatus")], [F.col("l_linenumber")], []]
    return table(spark, d, "lineitem").groupingSets(sets, "l_returnflag", "l_linestatus", "l_linenumber").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def rel_intersect(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, d, "supplier").select("s_nationkey"))
