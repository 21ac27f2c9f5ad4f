"""Keyed merges, constraint checks, numbering and table refresh.

Target: what the events of the first day leave behind.  Incoming: all later events.
"""

import uuid

from pyspark.sql import functions as F

from queries.registry import Tables, query
from strata.operators import constraints as K
from strata.operators import fold, upsert
from strata.operators.numbering import add_surrogate_id
from strata.schemas import columns
from strata.session import work_dir
from strata.sinks.store import Store, TableDef

_FIRST_DAY_ENDS = "2024-01-02"
_ROWS = """
    rows AS (SELECT user_id, event_type, event_id, ts AS created_at, ts AS updated_at,
                    nullif(event_type, 'error') AS kind,
                    CASE WHEN event_type <> 'view' THEN value END AS value FROM events),
    old AS (SELECT * FROM rows WHERE created_at < '2024-01-02'),
    new AS (SELECT * FROM rows WHERE created_at >= '2024-01-02')"""


def _sides(t: Tables, keys=("user_id",)):
    rows = t.events.select(
        "user_id",
        "event_type",
        "event_id",
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
        F.nullif("event_type", F.lit("error")).alias("kind"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
    )
    early = F.col("created_at") < F.lit(_FIRST_DAY_ENDS).cast("timestamp_ntz")
    kept = [*keys, "kind", "value", "created_at", "updated_at"]
    old = rows.where(early).select(*kept, "event_id")
    target = fold.fold_last(old, list(keys), ["event_id"], first=["created_at"])
    return target, rows.where(~early).select(*kept, "event_id")


def _last(table: str, key: str = "user_id") -> str:
    return f"""(SELECT {key}, kind, value, updated_at,
                  min(created_at) OVER (PARTITION BY {key}) AS created_at
                FROM {table} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY event_id DESC) = 1)"""


@query(
    f"""
    WITH {_ROWS}
    SELECT coalesce(t.user_id, i.user_id) AS user_id,
           CASE WHEN i.user_id IS NOT NULL THEN i.kind ELSE t.kind END AS kind,
           CASE WHEN i.user_id IS NOT NULL THEN i.value ELSE t.value END AS value,
           CASE WHEN t.user_id IS NOT NULL THEN t.created_at ELSE i.created_at END AS created_at,
           CASE WHEN i.user_id IS NOT NULL THEN i.updated_at ELSE t.updated_at END AS updated_at
    FROM {_last("old")} t FULL JOIN {_last("new")} i ON t.user_id = i.user_id
    """
)
def upsert_overwrite(t: Tables):
    """Incoming rows win, NULLs included; the first creation time stays."""
    target, incoming = _sides(t)
    return upsert.upsert_overwrite(target, incoming, ["user_id"], ["event_id"])


@query(
    f"""
    WITH {_ROWS}, i AS (
      SELECT user_id, arg_max(kind, event_id) FILTER (kind IS NOT NULL) AS kind,
             arg_max(value, event_id) FILTER (value IS NOT NULL) AS value,
             min(created_at) AS created_at, max(updated_at) AS updated_at
      FROM new GROUP BY 1)
    SELECT coalesce(t.user_id, i.user_id) AS user_id, coalesce(i.kind, t.kind) AS kind,
           coalesce(i.value, t.value) AS value, coalesce(t.created_at, i.created_at) AS created_at,
           coalesce(i.updated_at, t.updated_at) AS updated_at
    FROM {_last("old")} t FULL JOIN i ON t.user_id = i.user_id
    """
)
def upsert_preserve(t: Tables):
    """Only values that are present replace what the target holds."""
    target, incoming = _sides(t)
    return upsert.upsert_preserve(target, incoming, ["user_id"], ["event_id"])


@query(
    f"""
    WITH {_ROWS}, t AS (
      SELECT user_id, event_type, kind, value, min(created_at) OVER (PARTITION BY user_id, event_type) AS created_at,
             updated_at
      FROM old QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1)
    SELECT * FROM t
    UNION ALL
    SELECT user_id, event_type, kind, value, created_at, updated_at FROM (
      SELECT * FROM new QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1) n
    WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.user_id = n.user_id AND t.event_type = n.event_type)
    """
)
def insert_absent(t: Tables):
    """Existing keys stay untouched; the first row of each new key is added."""
    target, incoming = _sides(t, ("user_id", "event_type"))
    return upsert.insert_absent(target, incoming, ["user_id", "event_type"], ["event_id"])


@query(
    f"""
    WITH {_ROWS}
    SELECT user_id, kind, value, created_at, updated_at FROM {_last("old")}
    UNION ALL SELECT user_id, kind, value, created_at, updated_at FROM new
    """
)
def append_rows(t: Tables):
    """No key: every incoming row is added."""
    target, incoming = _sides(t)
    return upsert.append_rows(target, incoming)


@query(
    """
    SELECT user_id, event_id, event_type, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
    """
)
def latest_per_key(t: Tables):
    """Whole latest row per key."""
    rows = t.events.select("user_id", "event_id", "event_type", "props")
    return fold.latest_row(rows, ["user_id"], ["event_id"])


@query(
    """
    SELECT user_id, event_type, event_id, created_at FROM (
      SELECT user_id, event_type, event_id, min(ts) OVER (PARTITION BY user_id, event_type) AS created_at
      FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1)
    """
)
def fold_last_row(t: Tables):
    """Same-key rows of a batch folded: last row, first creation time."""
    rows = t.events.select("user_id", "event_type", "event_id", F.col("ts").alias("created_at"))
    keys = ["user_id", "event_type"]
    return fold.fold_last(rows, keys, ["event_id"], ["created_at"], rows.columns)


@query(
    """
    SELECT user_id, arg_max(event_type, event_id) FILTER (event_type <> 'view') AS kind,
           arg_max(value, event_id) FILTER (value > 20) AS value
    FROM events GROUP BY 1
    """
)
def fold_last_value(t: Tables):
    """Same-key rows folded column by column to the last value that is present."""
    rows = t.events.select(
        "user_id",
        F.nullif("event_type", F.lit("view")).alias("kind"),
        F.when(F.col("value") > 20, F.col("value")).alias("value"),
        "event_id",
    )
    return fold.fold_last_non_null(rows, ["user_id"], ["event_id"])


@query(
    """
    SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN 'quality is null' ELSE 'lang is not int' END AS reject_reason
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.quality IS NULL OR (d.lang IS NOT NULL AND try_cast(d.lang AS int) IS NULL)
    """
)
def quarantine(t: Tables):
    """Rows that break NOT NULL or a type, with the first reason."""
    rows = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    rules = K.Constraints(key=("doc_id",), not_null=("quality",), types={"lang": "int"})
    return K.split(K.check_rows(rows, rules))[1].select("doc_id", "reject_reason")


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(*) - 1 AS n_excess
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """
)
def constraint_check(t: Tables):
    """Primary keys held more than once."""
    return K.excess_per_key(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    """
    WITH held AS (SELECT DISTINCT user_id FROM events WHERE ts < '2024-01-01 06:00:00')
    SELECT event_id, user_id, CASE WHEN user_id IN (SELECT user_id FROM held)
             OR row_number() OVER (PARTITION BY user_id ORDER BY event_id) > 1 THEN 'duplicate key' END AS reject_reason
    FROM events WHERE ts >= '2024-01-01 06:00:00'
    """
)
def unique_check(t: Tables):
    """Plain inserts against a primary key: later rows of a taken key are rejected."""
    early = F.col("ts") < F.lit("2024-01-01 06:00:00").cast("timestamp_ntz")
    existing = t.events.where(early).select("user_id").distinct()
    rows = t.events.where(~early).select("event_id", "user_id")
    return K.check_unique(rows, ["user_id"], ["event_id"], existing)


@query(
    """
    SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS ingestion_id, o_orderkey, o_custkey FROM orders
    """
)
def surrogate_id(t: Tables):
    """Dense ids in arrival order."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return add_surrogate_id(rows, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("SELECT s_suppkey AS id, s_name AS name FROM supplier")
def full_refresh(t: Tables):
    """All rows of a table replaced in one commit; the older version is not read."""
    store = Store(t.spark, f"{work_dir(t.spark)}/refresh-{uuid.uuid4().hex}")
    table = TableDef("landing", "lnd_names", columns("id long, name string"), ("id",))
    store.create_if_absent(table)
    store.refresh(table, t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), "b1")
    store.refresh(table, t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), "b2")
    return store.read(table)
