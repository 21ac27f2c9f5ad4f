"""Reconciliation, lost records, batch state."""

import datetime as dt

from pyspark.sql import functions as F

from queries.registry import Tables, query
from strata.operators import audit, relate
from strata.operators.content import content_differences as differences
from strata.operators.curated import request_counts as count_requests

CHECKED = dt.datetime(2026, 5, 1, 15, 0, 0)


@query(
    """
    SELECT '20260501150000_cv1' AS etl_batch_id, 'landing_to_sanitised' AS phase_name, 'documents' AS source_table,
           'labels' AS target_table, s AS source_count, t AS target_count, s - t AS diff,
           CASE WHEN s = t THEN 'PASS' ELSE 'FAIL' END AS status, TIMESTAMP '2026-05-01 15:00:00' AS checked_at
    FROM (SELECT count(*) AS s FROM documents), (SELECT count(*) AS t FROM labels)
    """
)
def recon_counts(t: Tables):
    """Counts of two stages."""
    return audit.reconcile(
        t.documents, t.labels, "documents", "labels", "landing_to_sanitised", "20260501150000_cv1",
        F.lit(CHECKED).cast("timestamp_ntz"),
    )


@query(
    """
    WITH s AS (SELECT o_custkey AS artist_id, count(*) AS n FROM orders GROUP BY 1),
    t AS (SELECT o_custkey AS artist_id, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
    SELECT s.artist_id, s.n AS source_count, coalesce(t.n, 0) AS target_count, s.n - coalesce(t.n, 0) AS diff,
           CASE WHEN s.n = t.n THEN 'PASS' ELSE 'FAIL' END AS status
    FROM s LEFT JOIN t ON s.artist_id = t.artist_id
    """
)
def recon_by_key(t: Tables):
    """Counts of two stages per artist, the target having lost some orders."""
    rows = t.orders.select(F.col("o_custkey").alias("artist_id"), "o_orderstatus")
    return audit.reconcile_by(rows, rows.where(F.col("o_orderstatus") != "F"), ["artist_id"])


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def lost_records(t: Tables):
    """Source keys that did not arrive."""
    return relate.lost_records(t.documents, t.labels, ["doc_id"])


@query(
    """
    SELECT o_custkey AS artist_id, count(*) AS n_rows FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY') GROUP BY 1
    """
)
def orphans(t: Tables):
    """Foreign keys without a parent, against a parent table with holes."""
    parents = t.customer.where(F.col("c_mktsegment") != "MACHINERY")
    children = t.orders.select(F.col("o_custkey").alias("artist_id"))
    return relate.orphans(children, parents, "artist_id", "c_custkey")


@query(
    """
    SELECT o_orderkey, o_custkey AS artist_id FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')
    """
)
def orphan_rows(t: Tables):
    """The child rows whose parent is missing."""
    parents = t.customer.where(F.col("c_mktsegment") != "MACHINERY")
    children = t.orders.select("o_orderkey", F.col("o_custkey").alias("artist_id"))
    return relate.orphan_rows(children, parents, "artist_id", "c_custkey")


def _log(t: Tables):
    """Events as a batch log: a day is a batch, a user's share of it a phase."""
    kind = F.col("event_type")
    return t.events.select(
        F.date_format("ts", "yyyyMMdd").alias("etl_batch_id"),
        F.col("user_id").alias("phase_name"),
        F.when(kind == "error", audit.FAILED)
        .when(kind == "click", audit.STARTED)
        .otherwise(audit.SUCCEEDED)
        .alias("status"),
        F.when(kind != "error", F.get_json_object("props", "$.k").try_cast("bigint")).alias("rows_processed"),
        F.when(kind == "error", F.concat(F.lit("event "), "event_id")).alias("error_message"),
        "event_id",
    )


_LOG = """log AS (
    SELECT strftime(ts, '%Y%m%d') AS etl_batch_id, user_id AS phase_name,
           CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'STARTED' ELSE 'SUCCESS' END AS status,
           CASE WHEN event_type <> 'error' THEN (props->>'k')::bigint END AS rows_processed,
           CASE WHEN event_type = 'error' THEN 'event ' || event_id END AS error_message, event_id
    FROM events)"""
_PHASES = """phases AS (
    SELECT etl_batch_id, phase_name, arg_max(status, event_id) AS status,
           sum(rows_processed)::bigint AS rows_processed, arg_max(status, event_id) = 'SUCCESS' AS completed,
           bool_or(status = 'FAILED') AS ever_failed, arg_max(error_message, event_id) AS last_error
    FROM log GROUP BY 1, 2)"""


@query(f"WITH {_LOG}, {_PHASES} SELECT * FROM phases")
def batch_rollup(t: Tables):
    """State of every phase of every batch."""
    return audit.batch_rollup(_log(t), ["event_id"])


@query(
    f"""
    WITH {_LOG}, {_PHASES}
    SELECT etl_batch_id, count(*) AS phases, count(*) FILTER (NOT completed) AS incomplete_phases,
           sum(rows_processed)::bigint AS rows_processed, bool_and(completed) AS succeeded
    FROM phases GROUP BY 1
    """
)
def batch_outcome(t: Tables):
    """One row per batch: phases, which are incomplete, rows, success."""
    return audit.batch_outcome(audit.batch_rollup(_log(t), ["event_id"]))


@query(
    f"""
    WITH {_LOG}
    SELECT etl_batch_id, phase_name, status, event_id FROM log
    QUALIFY row_number() OVER (PARTITION BY etl_batch_id, phase_name ORDER BY event_id DESC) = 1
    """
)
def phase_status(t: Tables):
    """Latest log row of every phase."""
    return audit.phase_status(
        _log(t).select("etl_batch_id", "phase_name", "status", "event_id"), "event_id"
    )


@query("SELECT user_id AS request_key, count(*) AS n_records FROM events GROUP BY 1")
def request_counts(t: Tables):
    """Records received per request."""
    return count_requests(t.events.select(F.col("user_id").alias("request_key")))


_BAG = """SELECT l_orderkey, l_linenumber, count(*) AS n, list_sort(list(q)) AS qs, list_sort(list(f)) AS fs,
                  list_sort(list({'q': q, 'f': f})) AS bag FROM"""


@query(
    f"""
    WITH s AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_returnflag AS f, l_tax FROM lineitem),
    t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_tax = 0.08 THEN q + 1 ELSE q END AS q,
                 CASE WHEN l_tax = 0.08 THEN '?' WHEN f <> 'A' THEN f END AS f FROM s WHERE l_tax <> 0
          UNION ALL SELECT -l_orderkey, l_linenumber, q, f FROM s WHERE l_tax = 0.05),
    a AS ({_BAG} s GROUP BY 1, 2), b AS ({_BAG} t GROUP BY 1, 2),
    d AS (SELECT l_orderkey, l_linenumber, coalesce(a.n, 0) AS source_rows, coalesce(b.n, 0) AS target_rows,
                 a.qs <> b.qs AS q_moved, a.fs <> b.fs AS f_moved
          FROM a FULL JOIN b USING (l_orderkey, l_linenumber) WHERE a.bag IS DISTINCT FROM b.bag)
    SELECT l_orderkey, l_linenumber, source_rows, target_rows,
           CASE WHEN target_rows = 0 THEN 'missing' WHEN source_rows = 0 THEN 'extra'
                WHEN source_rows <> target_rows THEN 'repeated' ELSE 'changed' END AS verdict,
           CASE WHEN source_rows <> target_rows THEN '' ELSE
             concat_ws(',', CASE WHEN q_moved THEN 'l_quantity' END, CASE WHEN f_moved THEN 'l_returnflag' END) END AS changed
    FROM d
    """
)
def content_differences(t: Tables):
    """Line items against a copy that lost some, changed others without a change of counts, and made some up."""
    source = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_tax")
    high = F.col("l_tax") == 0.08
    flag = F.when(high, F.lit("?")).when(F.col("l_returnflag") != "A", F.col("l_returnflag"))
    kept = source.where(F.col("l_tax") != 0).withColumns(
        {"l_quantity": F.when(high, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")), "l_returnflag": flag}
    )
    made_up = source.where(F.col("l_tax") == 0.05).withColumn("l_orderkey", -F.col("l_orderkey"))
    found = differences(source, kept.unionByName(made_up), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_returnflag"])
    return found.withColumn("changed", F.concat_ws(",", "changed_columns")).drop("changed_columns")


@query(
    """
    WITH n AS (SELECT n_nationkey AS id, CASE WHEN n_regionkey NOT IN (SELECT r_regionkey FROM region WHERE r_name <> 'ASIA') THEN n_nationkey END AS b,
                 n_regionkey AS fk FROM nation),
    c AS (SELECT c_custkey AS id, c_nationkey AS fk, n.b FROM customer JOIN n ON c_nationkey = n.id WHERE c_mktsegment <> 'MACHINERY'),
    o AS (SELECT o_orderkey AS id, o_custkey AS fk, CASE WHEN c.id IS NULL THEN 'order' WHEN c.b IS NOT NULL THEN 'nation' END AS lv,
                 CASE WHEN c.id IS NULL THEN o_orderkey ELSE c.b END AS b FROM orders LEFT JOIN c ON o_custkey = c.id),
    l AS (SELECT l_linenumber AS id, l_orderkey AS fk, lv, b FROM lineitem JOIN o ON l_orderkey = o.id WHERE b IS NOT NULL)
    SELECT 'nation' AS level, id::varchar AS id, fk::varchar AS fk, 'nation' AS broken_level, b::varchar AS broken_id, 0 AS distance FROM n WHERE b IS NOT NULL
    UNION ALL SELECT 'customer', id::varchar, fk::varchar, 'nation', b::varchar, 1 FROM c WHERE b IS NOT NULL
    UNION ALL SELECT 'order', id::varchar, fk::varchar, lv, b::varchar, CASE lv WHEN 'order' THEN 0 ELSE 2 END FROM o WHERE b IS NOT NULL
    UNION ALL SELECT 'item', id::varchar, fk::varchar, lv, b::varchar, CASE lv WHEN 'order' THEN 1 ELSE 3 END FROM l
    """
)
def broken_chains(t: Tables):
    """Rows of four levels below a missing region or a missing customer, each with the row that lacks its parent."""
    levels = [
        ("nation", t.nation, "n_nationkey", "n_regionkey"),
        ("customer", t.customer.where(F.col("c_mktsegment") != "MACHINERY"), "c_custkey", "c_nationkey"),
        ("order", t.orders, "o_orderkey", "o_custkey"),
        ("item", t.lineitem, "l_linenumber", "l_orderkey"),
    ]
    return relate.broken_chains(t.region.where(F.col("r_name") != "ASIA"), "r_regionkey", levels)
