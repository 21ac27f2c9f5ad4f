"""Projections, cleaning functions and stamps."""

import datetime as dt

from pyspark.sql import functions as F

from queries.registry import Tables, query
from strata.functions import clean as C
from strata.functions import payload as P
from strata.functions import stamp
from strata.operators import project as J
from strata.schemas import columns
from strata.session import spread

AS_OF = dt.datetime(2026, 5, 1, 15, 0, 0)


@query(
    """
    SELECT event_id, (props->>'k')::int AS k, nullif(event_type, 'view') AS kind, value
    FROM events
    """
)
def sanitise_events(t: Tables):
    """Payloads to typed columns: each payload is parsed once."""
    payloads = spread(t.events).select(
        "event_id",
        P.serialise(
            F.when(F.col("event_type") == "view", F.lit("None")).otherwise(F.col("event_type")).alias("kind"),
            F.from_json("props", "k int").alias("props"),
            "value",
        ).alias("payload"),
    )
    fields = (
        J.Field("k", "$.props.k", "value", "int"),
        J.Field("kind", "$.kind"),
        J.Field("value", "$.value", "value", "double"),
    )
    return J.sanitise(payloads, fields, keep=("event_id",))


@query(
    """
    SELECT l_orderkey AS release_id, l_linenumber AS line, u.recording_id AS recording_id, u.kind AS kind
    FROM lineitem, LATERAL (
      SELECT l_partkey::varchar AS recording_id, 'part' AS kind
      UNION ALL SELECT l_suppkey::varchar, 'supplier'
      UNION ALL SELECT 'extra', l_shipdate::date::varchar WHERE l_linestatus = 'F'
    ) u
    """
)
def nested_child_explode(t: Tables):
    """Release bodies with two levels of arrays to child rows with their parent key."""
    item = lambda key, kind: F.struct(key.cast("string").alias("recording_id"), kind.alias("kind"))
    first = F.array(item(F.col("l_partkey"), F.lit("part")), item(F.col("l_suppkey"), F.lit("supplier")))
    second = F.when(
        F.col("l_linestatus") == "F",
        F.array(item(F.lit("extra"), F.col("l_shipdate").cast("date").cast("string"))),
    )
    parts = F.array(F.struct(first.alias("items")), F.struct(second.alias("items")))
    bodies = spread(t.lineitem).select(
        F.col("l_orderkey").alias("release_id"),
        F.col("l_linenumber").alias("line"),
        F.to_json(F.struct(parts.alias("parts"))).alias("payload"),
    )
    fields = (J.Field("recording_id", "$.recording_id"), J.Field("kind", "$.kind"))
    return J.sanitise(
        bodies, fields, child_steps=("$.parts", "$.items"), keep=("release_id", "line")
    )


@query(
    """
    SELECT n_nationkey::bigint AS id, n_name AS name, NULL::varchar AS missing,
           try_cast(n_name AS int) AS score, TIMESTAMP '2026-05-01 15:00:00' AS created_at
    FROM nation
    """
)
def target_projection(t: Tables):
    """Source rows onto the columns a target declares, by name and in its order."""
    target = columns("id long, name string, missing string, score int, created_at ntz")
    rows = t.nation.withColumn("created_at", F.lit(AS_OF).cast("timestamp_ntz"))
    return J.project_to(rows, target, {"id": "n_nationkey", "name": "n_name", "score": "n_name"})


@query(
    """
    SELECT c_name, CASE WHEN c_custkey <> 0 THEN c_custkey::varchar ELSE c_name END AS id
    FROM customer WHERE c_nationkey <> 3
    UNION ALL
    SELECT c_name, c_name FROM customer WHERE c_nationkey = 3
    """
)
def key_alias(t: Tables):
    """Key of a payload: ``id`` unless it is empty, else ``artist_id``."""
    blank = F.col("c_nationkey") == 3
    payloads = t.customer.select(
        "c_name",
        F.when(blank, P.serialise(F.lit("").alias("id"), F.col("c_name").alias("artist_id")))
        .otherwise(P.serialise(F.col("c_custkey").alias("id"), F.col("c_name").alias("artist_id")))
        .alias("payload"),
    )
    return J.key_alias(P.parsed(payloads)).select("c_name", "id")


@query(
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'O' THEN o_orderdate
                ELSE TIMESTAMP '2026-05-01 15:00:00' END AS created_at,
           TIMESTAMP '2026-05-01 15:00:00' AS updated_at
    FROM orders
    """
)
def audit_stamp(t: Tables):
    """``created_at`` only where absent ('', null words), ``updated_at`` always."""
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate").cast("string"))
        .when(F.col("o_orderstatus") == "F", F.lit("None"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
        .alias("created_at"),
    )
    stamped = stamp.audit_stamps(rows, AS_OF)
    return stamped.select(
        "o_orderkey", *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("created_at", "updated_at"))
    )


@query(
    """
    SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'unknown') AS status,
           TIMESTAMP '2026-05-01 15:00:00' AS ingestion_date
    FROM orders
    """
)
def column_defaults(t: Tables):
    """Declared defaults for NULL and for missing columns."""
    rows = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return stamp.column_defaults(
        rows, {"status": F.lit("unknown"), "ingestion_date": F.lit(AS_OF).cast("timestamp_ntz")}
    )


@query(
    """
    SELECT o_orderkey AS release_id, 'artist-1' AS artist_id, o_orderpriority AS title,
           strftime(o_orderdate, '%Y-%m-%d') AS date, o_custkey AS country, o_orderstatus AS status
    FROM orders
    """
)
def literal_key_projection(t: Tables):
    """Release fields with the requesting artist's key as a constant."""
    rows = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("title"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_custkey").alias("country"),
        F.col("o_orderstatus").alias("status"),
        "o_totalprice",
    )
    return J.release_projection(rows, "artist-1")


@query("SELECT c_custkey AS id FROM customer")
def key_extract(t: Tables):
    """Keys that drive an expansion."""
    return J.keys_of(t.customer.withColumnRenamed("c_custkey", "id"))


@query(
    """
    SELECT o_orderkey, o_custkey, '20260730173828_cv1' AS etl_batch_id FROM orders
    """
)
def batch_stamp(t: Tables):
    """Batch identity on every row."""
    return stamp.stamp_batch(t.orders.select("o_orderkey", "o_custkey"), "20260730173828_cv1")


@query(
    """
    SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') || '_' || event_type AS etl_batch_id FROM events
    """
)
def batch_id(t: Tables):
    """Batch identity from start time and source system."""
    return t.events.select("event_id", stamp.batch_id(F.col("ts"), F.col("event_type")).alias("etl_batch_id"))


_DATE_TEXT = """
    SELECT o_orderkey, CASE o_orderpriority
        WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y')
        WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m')
        WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y') || '-13'
        WHEN '4-NOT SPECIFIED' THEN 'None'
        ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw, o_orderdate, o_orderpriority
    FROM orders
"""


def _date_text(t: Tables):
    """Full, year-month, year-only, impossible and absent date texts."""
    day = F.col("o_orderdate")
    is_ = lambda p: F.col("o_orderpriority") == p
    return t.orders.select(
        "o_orderkey",
        F.when(is_("1-URGENT"), F.date_format(day, "yyyy"))
        .when(is_("2-HIGH"), F.date_format(day, "yyyy-MM"))
        .when(is_("3-MEDIUM"), F.concat(F.date_format(day, "yyyy"), F.lit("-13")))
        .when(is_("4-NOT SPECIFIED"), F.lit("None"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
        .alias("raw"),
        "o_orderpriority",
    )


@query(
    f"""
    WITH d AS ({_DATE_TEXT}), n AS (
      SELECT o_orderkey, CASE o_orderpriority
        WHEN '1-URGENT' THEN raw || '-01-01' WHEN '2-HIGH' THEN raw || '-01'
        WHEN '3-MEDIUM' THEN raw || '-01' WHEN '4-NOT SPECIFIED' THEN NULL ELSE raw END AS date_text
      FROM d)
    SELECT o_orderkey, date_text, try_cast(date_text AS date) AS release_date,
           date_text IS NOT NULL AND try_cast(date_text AS date) IS NULL AS bad_date,
           year(try_cast(date_text AS date))::int AS release_year
    FROM n
    """
)
def partial_dates(t: Tables):
    """Partial dates completed, typed where they are real, flagged where not."""
    rows = C.clean_strings(_date_text(t).select("o_orderkey", F.col("raw").alias("date_text")), ["date_text"])
    text = F.col("date_text")
    return rows.select(
        "o_orderkey",
        "date_text",
        C.to_day(text).alias("release_date"),
        C.bad_date(text).alias("bad_date"),
        F.year(C.to_day(text)).alias("release_year"),
    )


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN NULL
             WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN NULL
             WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN ' none '
             WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN ''
             ELSE o_orderpriority END AS status,
           o_orderstatus = 'O' OR (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS absent
    FROM orders
    """
)
def null_sentinels(t: Tables):
    """Null words in any case become NULL; blanks around them and '' stay."""
    open_, priority = F.col("o_orderstatus") == "O", F.col("o_orderpriority")
    filled = F.col("o_orderstatus") == "F"
    raw = (
        F.when(open_ & (priority == "1-URGENT"), F.lit("None"))
        .when(open_ & (priority == "2-HIGH"), F.lit("NULL"))
        .when(open_, F.lit("nUlL"))
        .when(filled & (priority == "1-URGENT"), F.lit(None))
        .when(filled & (priority == "2-HIGH"), F.lit(" none "))
        .when(filled & (priority == "3-MEDIUM"), F.lit(""))
        .otherwise(priority)
    )
    return t.orders.select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey", C.null_if_sentinel(F.col("raw")).alias("status"), C.is_null_word(F.col("raw")).alias("absent")
    )


@query(
    """
    SELECT vec_id, len(embedding)::int AS n, embedding[1]::double AS first, embedding[-1]::double AS last
    FROM embeddings
    """
)
def list_to_json(t: Tables):
    """Lists stored as JSON text; compared by value after parsing them again."""
    stored = t.embeddings.select("vec_id", P.as_json(F.col("embedding")).alias("text"))
    back = stored.select("vec_id", F.from_json("text", "array<float>").alias("e"))
    return back.select(
        "vec_id",
        F.size("e").alias("n"),
        F.element_at("e", 1).cast("double").alias("first"),
        F.element_at("e", -1).cast("double").alias("last"),
    )


@query(
    """
    SELECT vec_id, unnest(range(len(embedding)))::int AS pos, unnest(embedding)::double AS value FROM embeddings
    """
)
def list_elements(t: Tables):
    """Every element of the lists stored as JSON text, by its place, after parsing them again."""
    stored = t.embeddings.select("vec_id", P.as_json(F.col("embedding")).alias("text"))
    back = stored.select("vec_id", F.posexplode(F.from_json("text", "array<float>")).alias("pos", "value"))
    return back.withColumn("value", F.col("value").cast("double"))


@query(
    """
    SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_brand ELSE 'none' END AS brand,
           CASE WHEN p_size % 2 = 0 THEN p_size ELSE -1 END AS size
    FROM part
    """
)
def field_defaults(t: Tables):
    """Fields of stored payloads, with the default where a payload does not have the field."""
    size = F.col("p_size")
    body = F.struct(F.when(size % 3 == 0, F.col("p_brand")).alias("brand"), F.when(size % 2 == 0, size).alias("size"))
    stored = t.part.select("p_partkey", F.to_json(body).alias("payload"))
    v = F.col("v")
    return P.parsed(stored).select(
        "p_partkey",
        P.get_or(v, "$.brand", F.lit("none")).alias("brand"),
        P.get_or(v, "$.size", F.lit(-1), "int").alias("size"),
    )


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS kept,
           o_orderstatus <> 'O' AS stamped, TRUE AS in_time
    FROM orders
    """
)
def clock_stamp(t: Tables):
    """Audit stamps from the clock of the run: no time is given, one holds for all rows of a load."""
    start = dt.datetime.now(dt.timezone.utc).replace(microsecond=0).strftime("%Y-%m-%d %H:%M:%S")
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate").cast("string")).alias("created_at"))
    created, updated = F.col("created_at"), F.col("updated_at")
    return stamp.audit_stamps(rows).select(
        "o_orderkey",
        F.when(created != updated, created).cast("timestamp_ntz").alias("kept"),
        (created == updated).alias("stamped"),
        ((updated >= F.lit(start).cast("timestamp")) & (updated <= F.current_timestamp())).alias("in_time"),
    )


@query(
    """
    SELECT p_partkey, p_name || '''s "best"' AS name, nullif(p_brand, 'Brand#1') AS brand, p_size
    FROM part
    """
)
def object_to_json(t: Tables):
    """Objects stored as JSON text: quotes stay as they are, NULL fields are kept."""
    body = F.struct(
        F.concat("p_name", F.lit("'s \"best\"")).alias("name"),
        F.nullif("p_brand", F.lit("Brand#1")).alias("brand"),
        "p_size",
    )
    stored = t.part.select("p_partkey", P.as_json(body).alias("payload"))
    v = F.col("v")
    return P.parsed(stored).select(
        "p_partkey",
        P.get(v, "$.name").alias("name"),
        P.get(v, "$.brand").alias("brand"),
        P.get(v, "$.p_size", "int").alias("p_size"),
    )


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS iso FROM events")
def ts_to_iso(t: Tables):
    """Timestamps as ISO-8601 text in UTC."""
    return t.events.select("event_id", stamp.iso_text(F.col("ts").cast("timestamp")).alias("iso"))


@query(
    """
    SELECT o_orderkey, CASE o_orderpriority
        WHEN '1-URGENT' THEN 'string' WHEN '2-HIGH' THEN 'number' WHEN '3-MEDIUM' THEN 'list'
        WHEN '4-NOT SPECIFIED' THEN 'object' ELSE 'null' END AS kind,
      CASE o_orderpriority
        WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y') || '-01-01'
        WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y') END AS date_text
    FROM orders
    """
)
def type_dispatch(t: Tables):
    """Cleaning by JSON type: the string "1997" is a partial date, the number is not."""
    year, priority = F.date_format("o_orderdate", "yyyy"), F.col("o_orderpriority")
    value = (
        F.when(priority == "1-URGENT", F.concat(F.lit('"'), year, F.lit('"')))
        .when(priority == "2-HIGH", year)
        .when(priority == "3-MEDIUM", F.concat(F.lit("["), year, F.lit("]")))
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lit('{"y":'), year, F.lit("}")))
        .otherwise(F.lit("null"))
    )
    payload = F.concat(F.lit('{"d": '), value, F.lit("}"))
    rows = spread(t.orders).select("o_orderkey", payload.alias("payload"))
    date_text = J.Field("date_text", "$.d", "date_text")
    v = F.col("v")
    raw = P.parsed(rows).select("o_orderkey", P.kind(v, "$.d").alias("kind"), *date_text.read(v))
    out = raw.select("o_orderkey", "kind", date_text.clean())
    nested = F.col("kind").isin("list", "object")
    return out.withColumn("date_text", F.when(~nested, F.col("date_text")))


@query(
    """
    SELECT s_suppkey, CASE WHEN s_nationkey < 8 THEN s_name ELSE s_acctbal::varchar END AS label,
           CASE WHEN s_nationkey <> 0 THEN s_nationkey::bigint ELSE s_suppkey END AS code
    FROM supplier
    """
)
def truthy_coalesce(t: Tables):
    """First value that is not empty: '' and 0 fall through."""
    rows = t.supplier.withColumn(
        "given", F.when(F.col("s_nationkey") < 8, F.lit("")).otherwise(F.col("s_acctbal").cast("string"))
    ).withColumn("nation", F.col("s_nationkey").cast("bigint"))
    return rows.select(
        "s_suppkey",
        C.truthy_coalesce(rows, ["given", "s_name"]).alias("label"),
        C.truthy_coalesce(rows, ["nation", "s_suppkey"]).alias("code"),
    )


@query(
    """
    SELECT n_name, n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE r_name = 'ASIA'
    """
)
def country_filter(t: Tables):
    """Entities of one country; the filter reaches the dimension's scan."""
    from strata.operators.filters import in_country

    region = in_country(t.region, "ASIA", "r_name")
    return t.nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_name", "n_nationkey", "r_name"
    )
