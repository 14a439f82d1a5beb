"""Change data capture: pairing of before and after rows, and applying changes.

The envelope: event_id, event_type (INSERT, UPDATE, DELETE), key columns, data,
old_data, and a position that orders changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The operation codes of change tables.
OPERATIONS = {1: "DELETE", 2: "INSERT", 4: "UPDATE"}
BEFORE_IMAGE = 3
ENVELOPE = "event_id string, event_type string, database string, schema string, table string, ts timestamp, data map<string,string>, old_data map<string,string>, position string, correlation_id string"


def pair_updates(rows: DataFrame, order: list[str], operation: str, columns: list[str], partition: list[str]) -> DataFrame:
    """Change-table rows as events: the before image (3) of an update becomes
    ``old_<column>`` of the after image (4) that follows it in its partition."""
    w = Window.partitionBy(*partition).orderBy(*order, operation)
    old = [F.when((F.col(operation) == 4) & (F.lag(operation).over(w) == BEFORE_IMAGE), F.lag(c).over(w)).alias(f"old_{c}") for c in columns]
    kind = F.element_at(F.create_map(*[F.lit(x) for kv in OPERATIONS.items() for x in kv]), F.col(operation)).alias("event_type")
    return rows.select(*partition, *[c for c in order if c not in partition], F.col(operation), *columns, *old).where(F.col(operation) != BEFORE_IMAGE).select(*partition, *[c for c in order if c not in partition], kind, *columns, *[f"old_{c}" for c in columns])


def apply_changes(base: DataFrame, changes: DataFrame, key: str, order: str, event_type: str = "event_type") -> DataFrame:
    """The table after the changes: the last change of a key decides."""
    columns = base.columns
    last = changes.groupBy(key).agg(F.max_by(F.struct(event_type, *[c for c in columns if c != key]), order).alias("c")).select(key, "c.*")
    kept = base.join(last.select(key), key, "left_anti")
    return kept.select(*columns).unionByName(last.where(F.col(event_type) != "DELETE").select(*columns))


def decode(value: DataFrame, payload: str, schema: str = ENVELOPE) -> tuple[DataFrame, DataFrame]:
    """(decoded events, quarantined rows) of JSON envelopes."""
    parsed = value.withColumn("__p", F.from_json(F.col(payload), f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    bad = F.col("__p").isNull() | F.col("__p._corrupt_record").isNotNull()
    return parsed.where(~bad).select("__p.*").drop("_corrupt_record"), parsed.where(bad).drop("__p")
