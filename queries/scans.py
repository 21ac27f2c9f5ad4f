"""Scans and sources."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from queries.registry import Tables, query
from strata.functions import payload as P
from strata.functions import stamp
from strata.operators.filters import split_objects
from strata.operators.fold import head_n
from strata.operators.project import to_payload
from strata.session import spread, work_path
from strata.sources import drift, responses, snapshots, tables


@query(
    """
    SELECT event_id, user_id, event_type, value FROM events
    WHERE ts::date = (SELECT max(ts)::date FROM events)
    """
)
def latest_snapshot(t: Tables):
    """Rows of the newest day; the bound is a subquery the scan filters with."""
    return snapshots.latest_day_rows(t.events, "ts").select(
        "event_id", "user_id", "event_type", "value"
    )


@query(
    """
    SELECT event_id, user_id, strftime(ts, '%Y_%m_%d') AS stamp FROM events
    WHERE ts::date = DATE '2024-01-15'
    """
)
def dated_snapshot(t: Tables):
    """Rows of exactly one day, with the stamp of its snapshot name."""
    return snapshots.dated_rows(t.events, "ts", dt.date(2024, 1, 15)).select(
        "event_id", "user_id", stamp.date_stamp(F.col("ts")).alias("stamp")
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, u.pos AS pos, u.m AS m, round(u.x, 4) AS x
    FROM lineitem, LATERAL (
      SELECT * FROM (VALUES (0, 'quantity', l_quantity), (2, 'tax', l_tax)) v(pos, m, x)
      WHERE l_returnflag = 'N'
      UNION ALL SELECT 0, 'price', l_extendedprice WHERE l_returnflag = 'A'
    ) u
    """
)
def json_array_scan(t: Tables):
    """Bodies that are an array with a scalar in it, a single object, or cut off."""
    measure = lambda name, c: P.serialise(F.lit(name).alias("m"), F.col(c).alias("x"))
    array = F.concat(
        F.lit("["), measure("quantity", "l_quantity"), F.lit(", 5, "), measure("tax", "l_tax"), F.lit("]")
    )
    body = (
        F.when(F.col("l_returnflag") == "N", array)
        .when(F.col("l_returnflag") == "A", measure("price", "l_extendedprice"))
        .otherwise(F.lit('[{"m": "cut'))
    )
    rows = snapshots.unwrap_arrays(spread(t.lineitem).select("l_orderkey", "l_linenumber", body.alias("value")))
    objects, _ = split_objects(rows)
    parsed = objects.withColumn("p", F.from_json("element", "m string, x double"))
    return parsed.select("l_orderkey", "l_linenumber", "pos", "p.m", F.round("p.x", 4).alias("x"))


@query(
    """
    SELECT c_custkey AS request_key, 0 AS pos, c_name AS name FROM customer WHERE c_acctbal >= 0
    UNION ALL
    SELECT c_custkey, 1, c_mktsegment FROM customer WHERE c_acctbal >= 0
    """
)
def envelope_unwrap(t: Tables):
    """Response bodies to entities; a body without the list gives none."""
    item = lambda c: F.struct(F.col(c).alias("name"))
    body = F.when(
        F.col("c_acctbal") >= 0,
        F.to_json(F.struct(F.array(item("c_name"), item("c_mktsegment")).alias("artists"))),
    ).otherwise(F.lit('{"error": "not found"}'))
    bodies = t.customer.select(F.col("c_custkey").alias("request_key"), body.alias("body"))
    items = P.parsed(responses.unwrap_envelope(bodies, "artists"), "element")
    return items.select(
        "request_key", "pos", P.get_or(F.col("v"), "$.name", F.lit("?")).alias("name")
    )


@query(
    """
    SELECT c_custkey AS request_key, 'no artists in body' AS reject_reason
    FROM customer WHERE NOT c_acctbal >= 0
    """
)
def envelope_strict(t: Tables):
    """Strict unwrap: a body without the list is an error and is kept aside."""
    body = F.when(F.col("c_acctbal") >= 0, F.lit('{"artists": []}')).otherwise(F.lit("{}"))
    bodies = t.customer.select(F.col("c_custkey").alias("request_key"), body.alias("body"))
    _, missing = responses.split_strict_envelope(bodies, "artists")
    return missing.select("request_key", "reject_reason")


@query(
    """
    SELECT 'r' || c_nationkey AS run_id, c_custkey::varchar AS request_key, (c_custkey % 7)::int AS ord,
           CASE WHEN c_acctbal >= 0 THEN 200 ELSE 404 END AS status_code, c_name AS name
    FROM customer WHERE c_custkey % 2 = 0
    """
)
def captured_responses(t: Tables):
    """Responses captured as JSON lines and read back, one endpoint of two."""
    captured = t.customer.select(
        F.concat(F.lit("r"), "c_nationkey").alias("run_id"),
        F.when(F.col("c_custkey") % 2 == 0, "artist").otherwise("release").alias("endpoint"),
        F.col("c_custkey").cast("string").alias("request_key"),
        (F.col("c_custkey") % 7).cast("int").alias("ord"),
        F.when(F.col("c_acctbal") >= 0, 200).otherwise(404).alias("status_code"),
        F.to_json(F.struct(F.col("c_name").alias("name"))).alias("body"),
    )
    at = work_path(t.spark, "captured")
    captured.write.json(at)
    rows = responses.read_responses(t.spark, at, "artist")
    return rows.select("run_id", "request_key", "ord", "status_code", F.get_json_object("body", "$.name").alias("name"))


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
           o_totalprice, o_orderdate::date AS o_orderdate
    FROM orders
    """
)
def payload_roundtrip(t: Tables):
    """Whole rows to JSON payloads and back through a fixed schema."""
    rows = spread(t.orders).withColumns(
        {
            "o_orderdate": F.col("o_orderdate").cast("date"),
            "o_orderpriority": F.nullif("o_orderpriority", F.lit("5-LOW")),
        }
    )
    return tables.parse_payload(to_payload(rows), rows.schema)


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5
    """
)
def head5(t: Tables):
    """First five rows in arrival order."""
    return head_n(t.orders, [F.col("o_orderdate"), F.col("o_orderkey")], 5).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query(
    """
    SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, NULL::varchar AS segment FROM supplier
    UNION ALL
    SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
    """
)
def concat_all(t: Tables):
    """Results of several requests after one another, duplicates kept."""
    suppliers = t.supplier.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    customers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    return responses.concat_all(suppliers, customers, suppliers)


@query("SELECT event_id, user_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'")
def incremental_read(t: Tables):
    """Rows updated after a mark; the literal reaches the scan."""
    mark = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    return tables.changed_since(t.events, mark, "ts").select("event_id", "user_id", "ts")


@query(
    """
    WITH n AS (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1)
    SELECT v.path, v.verdict, v.declared, v.found, coalesce(v.n, 0)::bigint AS n FROM (
      SELECT '$.items[].qty' AS path, 'retyped' AS verdict, 'long' AS declared, 'STRING' AS found, (SELECT n FROM n WHERE s = 'F') AS n
      UNION ALL SELECT '$.note', 'new', NULL, 'BIGINT,STRING', (SELECT sum(n) FROM n WHERE s <> 'F')
      UNION ALL SELECT '$.status', 'retyped', 'string', 'BOOLEAN', (SELECT n FROM n WHERE s = 'P')
      UNION ALL SELECT '$.country', 'lost', 'string', '', 0) v
    """
)
def schema_drift(t: Tables):
    """Orders as payloads whose members have drifted from their target: one lost, one new, two of other types in part."""
    status = F.col("o_orderstatus")
    quoted = F.to_json(F.struct(F.col("o_orderpriority").alias("x")))
    qty = F.when(status == "F", F.lit('"1"')).otherwise(F.lit("1"))
    note = F.when(status == "F", F.lit("")).when(status == "O", F.lit(',"note":1')).otherwise(F.lit(',"note":"n"'))
    said = F.when(status == "P", F.lit("true")).otherwise(F.lit('"done"'))
    payload = F.concat(
        F.lit('{"id":'), "o_orderkey", F.lit(',"country":null,"status":'), said, F.lit(',"title":'), quoted,
        F.lit(',"items":[{"qty":'), qty, F.lit("}]"), note, F.lit("}"),
    )
    item = T.StructType([T.StructField("qty", T.LongType())])
    title = T.StructType([T.StructField("x", T.StringType())])
    fields = {"id": T.LongType(), "country": T.StringType(), "status": T.StringType(), "title": title, "items": T.ArrayType(item)}
    target = T.StructType([T.StructField(k, v) for k, v in fields.items()])
    return drift.schema_drift(drift.type_profile(t.orders.select(payload.alias("payload")), depth=drift.depth_of(target)), target)
