"""Whole loads over files and layer tables, in the work folder of the session."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from queries.curated import _BASE
from queries.registry import Tables, query
from strata.functions import payload as P
from strata.operators.numbering import add_surrogate_id
from strata.operators.upsert import upsert_overwrite
from strata.plans.batch import phase_log, run_batch
from strata.plans.config import BATCH_LOG, CURATED, QUARANTINE_TABLE, RECON_LOG, Run, standard_entities
from strata.plans.curate import curate
from strata.plans.extract import STOP, extract, split_usable
from strata.plans.load import load_landing, load_sanitised, set_up
from strata.plans.maintain import maintain
from strata.schemas import columns
from strata.session import spread, work_dir
from strata.sinks.snapshots import write_partitioned_snapshot, write_snapshot
from strata.sinks.store import Store, TableDef
from strata.sources import responses, snapshots, tables

DAY1, DAY2 = dt.date(2026, 5, 1), dt.date(2026, 5, 2)


def _folder(t: Tables, name: str) -> str:
    return f"{work_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


def _release_objects(t: Tables, orders):
    """Orders as the release objects a source would send."""
    return spread(orders).select(
        P.serialise(
            F.col("o_orderkey").cast("string").alias("id"),
            F.col("o_custkey").cast("string").alias("artist_id"),
            F.concat_ws("-", "o_custkey", "o_orderpriority").alias("group_id"),
            F.col("o_orderpriority").alias("title"),
            F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
            .alias("date"),
            F.when(F.col("o_orderpriority") == "5-LOW", F.lit("None"))
            .otherwise(F.col("o_orderpriority"))
            .alias("country"),
            F.col("o_orderstatus").alias("status"),
        ).alias("element")
    )


def _loaded(t: Tables, archive: bool = False) -> tuple[Store, dict]:
    """Two daily snapshots of the releases, the first without the open orders."""
    root = _folder(t, "layers")
    raw = f"{root}/raw"
    entities = {"releases": standard_entities(buckets=8, layout="lines")["releases"]}
    store = Store(t.spark, f"{root}/store")
    set_up(store, entities)
    for day, rows in ((DAY1, t.orders.where(F.col("o_orderstatus") != "O")), (DAY2, t.orders)):
        write_snapshot(_release_objects(t, rows), f"{raw}/releases", "releases", day)
        load_landing(store, entities["releases"], Run(f"{day:%Y%m%d}000000_src", f"{day} 00:00:00", raw, archive=archive))
    return store, entities


@query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'")
def snapshot_write(t: Tables):
    """Dated snapshots written and read back: the newest day, written twice."""
    folder = _folder(t, "snapshots")
    rows = t.orders.select(
        "o_orderstatus", P.serialise("o_orderkey", "o_custkey", "o_orderpriority").alias("element")
    )
    write_snapshot(rows, folder, "orders", DAY1)
    write_snapshot(rows, folder, "orders", DAY2)
    write_snapshot(rows.where(F.col("o_orderstatus") != "F"), folder, "orders", DAY2)
    newest = snapshots.latest_snapshot_path(t.spark, folder, "orders", "jsonl")
    schema = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority").schema
    return tables.parse_payload(snapshots.read_json_lines(t.spark, newest).select("element"), schema, "element")


@query(
    """
    SELECT o_orderkey, DATE '2026-05-02' AS snapshot_date FROM orders WHERE o_orderstatus = 'F'
    """
)
def snapshot_partitions(t: Tables):
    """Snapshots as one folder partitioned by day; only the rewritten day changes."""
    folder = _folder(t, "days")
    rows = t.orders.select("o_orderstatus", P.serialise("o_orderkey").alias("element"))
    write_partitioned_snapshot(rows, folder, DAY1)
    write_partitioned_snapshot(rows, folder, DAY2)
    write_partitioned_snapshot(rows.where(F.col("o_orderstatus") == "F"), folder, DAY2)
    days = t.spark.read.schema("value string, snapshot_date date").text(folder)
    newest = snapshots.latest_rows(days, "snapshot_date")
    return tables.parse_payload(newest, t.orders.select("o_orderkey").schema, "value").select(
        "o_orderkey", "snapshot_date"
    )


@query(
    """
    SELECT o_orderkey::varchar AS id, o_orderstatus AS status,
           CASE WHEN o_orderstatus <> 'O' THEN TIMESTAMP '2026-05-01' ELSE TIMESTAMP '2026-05-02' END AS created_at,
           TIMESTAMP '2026-05-02' AS updated_at
    FROM orders
    """
)
def landing_load(t: Tables):
    """Two snapshots through the generic landing load."""
    store, entities = _loaded(t)
    landed = store.read(entities["releases"].landing)
    return P.parsed(landed).select(
        "id",
        P.get(F.col("v"), "$.status").alias("status"),
        *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("created_at", "updated_at")),
    )


@query(
    """
    SELECT o_orderkey::varchar AS release_id, o_custkey::varchar AS artist_id,
           o_custkey || '-' || o_orderpriority AS group_id, o_orderpriority AS title,
           CASE WHEN o_orderstatus = 'P' THEN date_trunc('year', o_orderdate)::date ELSE o_orderdate::date END AS release_date,
           CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-01-01')
                ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_raw,
           nullif(o_orderpriority, '5-LOW') AS country, o_orderstatus AS status,
           TIMESTAMP '2026-05-02' AS ingestion_date
    FROM orders
    """
)
def sanitised_load(t: Tables):
    """Landing payloads through the generic sanitise load."""
    store, entities = _loaded(t)
    load_sanitised(store, entities["releases"], Run("20260502000000_src", f"{DAY2} 00:00:00", ""))
    return store.read(entities["releases"].sanitised).drop("etl_batch_id")


@query(
    """
    SELECT o_orderkey::varchar AS id, TIMESTAMP '2026-05-01' AS updated_at FROM orders WHERE o_orderstatus <> 'O'
    """
)
def archived_version(t: Tables):
    """The landing rows that the second load superseded, in the archive of its batch."""
    store, entities = _loaded(t, archive=True)
    table = entities["releases"].landing
    path = store.archive_folder(table, "20260502000000_src")
    return t.spark.read.schema(table.columns).parquet(path).select(
        "id", F.col("updated_at").cast("timestamp_ntz").alias("updated_at")
    )


@query(
    """
    SELECT o_orderkey::varchar AS id, o_custkey::varchar AS artist_id, o_orderstatus AS status
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal >= 0 AND o_orderstatus <> 'P'
    """
)
def extraction_run(t: Tables):
    """Captured searches and browses to snapshots; the artists found drive the releases."""
    artist = F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    searches = spread(t.customer).select(
        F.lit("artist").alias("endpoint"),
        F.col("c_name").alias("request_key"),
        F.col("c_custkey").alias("ord"),
        F.when(F.col("c_acctbal") < 0, 500).otherwise(200).alias("status_code"),
        F.to_json(F.struct(F.array(artist).alias("artists"))).alias("body"),
    )
    release = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"))
    browses = spread(t.orders).select(
        F.lit("release").alias("endpoint"),
        F.col("o_custkey").cast("string").alias("request_key"),
        F.col("o_orderkey").alias("ord"),
        F.when(F.col("o_orderstatus") == "P", 404).otherwise(200).alias("status_code"),
        F.to_json(F.struct(F.array(release).alias("releases"))).alias("body"),
    )
    run = Run("20260501000000_src", f"{DAY1} 00:00:00", _folder(t, "extract"), DAY1)
    paths = extract(responses.concat_all(searches, browses), run)
    rows = tables.parse_payload(
        snapshots.read_json_lines(t.spark, paths["releases"]).select("element"),
        columns("id string, artist_id string, status string"),
        "element",
    )
    return rows


@query(
    f"""
    {_BASE}, s AS (SELECT release_id, count(recording_id) AS n FROM recordings GROUP BY 1)
    SELECT a.artist_id::varchar AS artist_id, a.name, a.country::varchar AS country, count(r.release_id) AS release_count,
           count(DISTINCT r.group_id) AS album_count, coalesce(sum(s.n), 0)::bigint AS recording_count,
           min(release_date) AS first_release_date, max(release_date) AS last_release_date
    FROM artists a LEFT JOIN releases r ON a.artist_id = r.artist_id LEFT JOIN s ON r.release_id = s.release_id
    GROUP BY 1, 2, 3
    """
)
def curation_stage(t: Tables):
    """Sanitised tables through the curation stage; the artist metrics it publishes."""
    store = Store(t.spark, _folder(t, "curation"))
    entities = standard_entities()
    set_up(store, entities)
    frames = {"artists": t.artists, "releases": t.releases, "recordings": t.recordings, "urls": t.urls}
    for name, rows in frames.items():
        table = entities[name].sanitised
        missing = [f.name for f in table.columns if f.name not in rows.columns]
        store.refresh(table, rows.withColumns({c: F.lit(None) for c in missing}), "b1")
    curate(store, entities, Run("b1", f"{DAY1} 00:00:00", ""))
    return store.read(CURATED["artist_metrics"]).drop("etl_batch_id")


@query(
    """
    WITH r AS (SELECT o_orderkey AS ord, o_custkey::varchar AS request_key, u.run_id,
                 CASE WHEN o_orderkey % 1000 = 999 THEN 503 ELSE 200 END AS status_code,
                 u.run_id = 'b' AND o_orderkey % 700 = 650 AS cut
               FROM orders, (VALUES ('a'), ('b')) u(run_id)),
    f AS (SELECT run_id, min(ord) AS first FROM r WHERE status_code = 503 OR cut GROUP BY 1)
    SELECT r.run_id, ord, request_key,
      CASE WHEN first IS NULL OR ord < first THEN 'kept' WHEN status_code = 503 THEN 'status 503'
           WHEN cut THEN 'body is not JSON' ELSE 'after a failure' END AS verdict
    FROM r LEFT JOIN f ON r.run_id = f.run_id
    """
)
def extraction_stop_at_failure(t: Tables):
    """Two captured runs with the same keys, each kept up to its first failure; one of
    them meets a body that was cut off.  Nothing is left out without a reason."""
    good = P.serialise(F.col("o_orderkey").cast("string").alias("id"))
    cut = (F.col("run_id") == "b") & (F.col("o_orderkey") % 700 == 650)
    rows = spread(t.orders).withColumn("run_id", F.explode(F.array(F.lit("a"), F.lit("b"))))
    captured = rows.select(
        "run_id",
        F.lit("release").alias("endpoint"),
        F.col("o_custkey").cast("string").alias("request_key"),
        F.col("o_orderkey").alias("ord"),
        F.when(F.col("o_orderkey") % 1000 == 999, 503).otherwise(200).alias("status_code"),
        F.when(cut, F.lit('{"id":')).otherwise(good).alias("body"),
    )
    kept, dropped = split_usable(captured, STOP)
    both = kept.withColumn("reject_reason", F.lit("kept")).unionByName(dropped)
    return both.select("run_id", "ord", "request_key", F.col("reject_reason").alias("verdict"))


@query(
    """
    WITH c AS (SELECT c_custkey::varchar AS id, c_custkey % 7 = 3 AS nameless, c_custkey % 5 = 2 AS misfit, c_custkey FROM customer)
    SELECT id, CASE WHEN nameless AND NOT misfit THEN 'name is null' WHEN misfit THEN 'score is not int' ELSE 'published' END AS outcome,
      CASE WHEN NOT nameless AND NOT misfit THEN c_custkey::integer END AS score, '20260501000000_src' AS etl_batch_id
    FROM c
    """
)
def sanitised_rejects(t: Tables):
    """Artists of which some have no name and some a score that is no number: what is
    published, and what is quarantined for which reason, after the load has been repeated."""
    root, batch = _folder(t, "rejects"), "20260501000000_src"
    artist = P.serialise(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(F.col("c_custkey") % 7 != 3, F.col("c_name")).alias("name"),
        F.when(F.col("c_custkey") % 5 == 2, F.lit("many")).otherwise(F.col("c_custkey").cast("string")).alias("score"),
    )
    entities = {"artists": standard_entities(layout="lines")["artists"]}
    artists, store = entities["artists"], Store(t.spark, f"{root}/store")
    set_up(store, entities)
    write_snapshot(t.customer.select(artist.alias("element")), f"{root}/raw/artists", "artists", DAY1)
    run = Run(batch, f"{DAY1} 00:00:00", f"{root}/raw")
    for _ in range(2):
        load_landing(store, artists, run)
        load_sanitised(store, artists, run)
    published = store.read(artists.sanitised).select(
        F.col("artist_id").alias("id"), F.lit("published").alias("outcome"), "score", F.lit(batch).alias("etl_batch_id")
    )
    rejected = store.read(QUARANTINE_TABLE).select(
        F.col("src").alias("id"), F.col("reject_reason").alias("outcome"), F.lit(None).cast("int").alias("score"), "etl_batch_id"
    )
    return published.unionByName(rejected)


@query("SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS place, o_orderkey FROM orders")
def arrival_order(t: Tables):
    """Objects of a split snapshot numbered as they stand in its files."""
    folder = _folder(t, "arrival")
    rows = t.orders.select("o_orderkey", P.serialise("o_orderkey").alias("element"))
    path = write_snapshot(rows, folder, "orders", DAY1, order=["o_orderkey"])
    read = snapshots.read_json_lines(t.spark, path).select("element", "_ord.*")
    numbered = add_surrogate_id(read, ["src_file", "block", "pos", "part"], "place", start_after=-1)
    return numbered.select("place", F.get_json_object("element", "$.o_orderkey").cast("long").alias("o_orderkey"))


@query(
    """
    SELECT c_custkey::varchar AS id, c_name AS name,
           CASE WHEN c_custkey < 10 THEN 'second' ELSE 'first' END AS etl_batch_id FROM customer
    """
)
def merge_hit_buckets(t: Tables):
    """A small batch merged into a table of 64 buckets; the buckets it does not hit stay as they are."""
    store = Store(t.spark, _folder(t, "buckets"))
    table = TableDef("landing", "lnd_names", columns("id string, name string, etl_batch_id string"), ("id",), 64)
    store.create_if_absent(table)
    rows = t.customer.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), "c_custkey")

    def merge(batch, name):
        stamped = batch.withColumn("etl_batch_id", F.lit(name))
        store.merge(table, stamped, lambda held, new: upsert_overwrite(held, new, ["id"], ["c_custkey"], None, table.tasks(held, new)))

    merge(rows.withColumn("name", F.when(F.col("c_custkey") < 10, F.lit("old")).otherwise(F.col("name"))), "first")
    merge(rows.where("c_custkey < 10"), "second")
    return store.read(table)


@query(
    """
    SELECT o_orderkey::varchar AS release_id, o_orderstatus AS status,
           CASE o_orderstatus WHEN 'F' THEN 'b1' WHEN 'O' THEN 'b2' ELSE 'b0' END AS etl_batch_id FROM orders
    """
)
def incremental_batches(t: Tables):
    """Increments by batch: two batches of one time with a sanitised load after each, and one that comes late
    with an earlier time; every row arrives, under the batch that brought it."""
    root = _folder(t, "increments")
    releases = standard_entities(buckets=8, layout="lines")["releases"]
    store = Store(t.spark, f"{root}/store")
    set_up(store, {"releases": releases})
    for batch, status, day in (("b1", "F", DAY2), ("b2", "O", DAY2), ("b0", "P", DAY1)):
        run = Run(batch, f"{day} 00:00:00", f"{root}/{batch}")
        rows = _release_objects(t, t.orders.where(F.col("o_orderstatus") == status))
        write_snapshot(rows, f"{root}/{batch}/releases", "releases", day)
        load_landing(store, releases, run)
        load_sanitised(store, releases, run)
    return store.read(releases.sanitised).select("release_id", "status", "etl_batch_id")


@query(
    """
    WITH c AS (SELECT count(*) AS n, count(*) FILTER (c_custkey % 7 <> 3) AS good FROM customer),
    o AS (SELECT count(*) AS n FROM orders)
    SELECT 'phase' AS entry, v.* FROM c, o, (VALUES
      ('crm', 'people', 'batch', 'SUCCESS', good, NULL::bigint), ('crm', 'people', 'load_landing_artists', 'SUCCESS', c.n, NULL),
      ('crm', 'people', 'load_sanitised_artists', 'SUCCESS', good, NULL), ('shop', 'catalogue', 'batch', 'SUCCESS', o.n, NULL),
      ('shop', 'catalogue', 'load_landing_releases', 'SUCCESS', o.n, NULL),
      ('shop', 'catalogue', 'load_sanitised_releases', 'SUCCESS', o.n, NULL)) v(source_system, group_name, phase_name, status, n, diff)
    UNION ALL
    SELECT 'recon', v.* FROM c, o, (VALUES
      ('raw.artists', 'landing.lnd_artists', 'recon_raw_artists', 'PASS', c.n, 0::bigint),
      ('landing.lnd_artists', 'sanitised.san_artists', 'recon_artists', 'FAIL', good, c.n - good),
      ('raw.releases', 'landing.lnd_releases', 'recon_raw_releases', 'PASS', o.n, 0),
      ('landing.lnd_releases', 'sanitised.san_releases', 'recon_releases', 'PASS', o.n, 0)) v(source_system, group_name, phase_name, status, n, diff)
    """
)
def batch_run(t: Tables):
    """A batch over two entity groups of two systems: what its log and its reconciliation say.  Some artists
    have no name and are rejected, which the counts show."""
    root = _folder(t, "batch")
    artist = P.serialise(
        F.col("c_custkey").cast("string").alias("id"), F.when(F.col("c_custkey") % 7 != 3, F.col("c_name")).alias("name")
    )
    groups = {"artists": ("crm", "people"), "releases": ("shop", "catalogue")}
    entities = standard_entities(buckets=8, layout="lines", groups=groups)
    entities = {name: entities[name] for name in groups}
    write_snapshot(t.customer.select(artist.alias("element")), f"{root}/raw/artists", "artists", DAY1)
    write_snapshot(_release_objects(t, t.orders), f"{root}/raw/releases", "releases", DAY1)
    store = Store(t.spark, f"{root}/store")
    run_batch(store, entities, Run("20260501000000_src", f"{DAY1} 00:00:00", f"{root}/raw"), curation=False)
    phases = phase_log(store.read(BATCH_LOG)).select(
        F.lit("phase").alias("entry"),
        "source_system",
        "group_name",
        "phase_name",
        "status",
        F.col("rows_processed").alias("n"),
        F.lit(None).cast("long").alias("diff"),
    )
    recon = store.read(RECON_LOG).select(
        F.lit("recon"), "source_table", "target_table", "phase_name", "status", "target_count", "diff"
    )
    return phases.union(recon)


@query("SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def array_split_scan(t: Tables):
    """Orders as compact arrays, each file a single line, read by byte ranges; the file that lacks its
    last bracket gives no rows."""
    folder = _folder(t, "arrays")
    element = P.serialise("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    for status in ("F", "O", "P"):
        rows = t.orders.where(F.col("o_orderstatus") == status)
        first, last = rows.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
        begin = F.when(F.col("o_orderkey") == first, F.lit("[")).otherwise(F.lit(""))
        end = F.when(F.col("o_orderkey") < last, F.lit(",")).otherwise(F.lit("" if status == "P" else "]"))
        lines = rows.select("o_orderkey", F.concat(begin, element, end).alias("value")).coalesce(1)
        lines.sortWithinPartitions("o_orderkey").select("value").write.text(f"{folder}/{status}", lineSep=" ")
    read = snapshots.read_split_arrays(t.spark, [f"{folder}/{status}" for status in ("F", "O", "P")])
    schema = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus").schema
    return tables.parse_payload(read.select("element"), schema, "element")


@query(
    f"""
    {_BASE}, s AS (SELECT release_id, count(DISTINCT recording_id) AS n FROM recordings GROUP BY 1),
    u AS (SELECT release_id, count(DISTINCT url_id) AS n FROM urls GROUP BY 1),
    m AS (SELECT a.artist_id, a.country, count(r.release_id) AS rc, count(DISTINCT r.group_id) AS ac,
            coalesce(sum(s.n), 0)::bigint AS sc, min(release_date) AS lo, max(release_date) AS hi,
            count(DISTINCT r.country) AS cc, count(DISTINCT r.status) AS tc
          FROM artists a LEFT JOIN releases r ON a.artist_id = r.artist_id LEFT JOIN s ON r.release_id = s.release_id GROUP BY 1, 2)
    SELECT 'artist' AS entry, artist_id::varchar AS key, rc AS n1, ac AS n2, sc AS n3, lo AS first_date, hi AS last_date FROM m
    UNION ALL SELECT 'discography', artist_id::varchar, rc, cc, tc, lo, hi FROM m
    UNION ALL SELECT 'country', country::varchar, count(*), sum(rc)::bigint, sum(sc)::bigint, NULL, NULL FROM m GROUP BY 2
    UNION ALL SELECT 'release', release_id::varchar, coalesce(s.n, 0), coalesce(u.n, 0), year(release_date), NULL, NULL
      FROM releases LEFT JOIN s USING (release_id) LEFT JOIN u USING (release_id)
    UNION ALL SELECT 'recording', recording_id::varchar, count(DISTINCT rec.release_id), count(DISTINCT r.artist_id), NULL, NULL, NULL
      FROM recordings rec LEFT JOIN releases r ON rec.release_id = r.release_id GROUP BY 2
    """
)
def maintained_metrics(t: Tables):
    """All curated tables by the differences of three batches; a recording or url counts once per release, its
    key in the sanitised tables.  Releases come under a wrong artist, date and status, then
    corrected with the open orders and the returned line items, then the other line items."""
    store = Store(t.spark, _folder(t, "maintained"))
    entities = standard_entities(buckets=8)
    set_up(store, entities)
    done = F.col("status") != "O"
    wrong = t.releases.where(done).withColumns(
        {"artist_id": F.col("artist_id") + 1, "release_date": F.date_add("release_date", 400), "status": F.lit("X")}
    )
    returned = F.col("l_returnflag") == "R"
    items = t.lineitem.select(
        F.col("l_partkey").alias("recording_id"), F.col("l_orderkey").alias("release_id"), "l_returnflag"
    )
    batches = {
        "b1": {"artists": t.artists.withColumn("country", F.lit("none")), "releases": wrong},
        "b2": {"artists": t.artists, "releases": t.releases, "recordings": items.where(returned).drop("l_returnflag")},
        "b3": {"recordings": items.where(~returned).drop("l_returnflag"), "urls": t.urls},
    }
    for batch, frames in batches.items():
        for name, rows in frames.items():
            table = entities[name].sanitised
            missing = [c for c in table.columns.fieldNames() if c not in rows.columns]
            rows = rows.withColumns({c: F.lit(None).cast("string") for c in missing}).withColumn("etl_batch_id", F.lit(batch))
            rows = rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in table.columns))
            store.merge(
                table, rows, lambda held, new, k=table: upsert_overwrite(held, new, k.key, ["etl_batch_id"], None, k.tasks(held, new))
            )
        made = maintain(store, entities, Run(batch, f"{DAY1} 00:00:00", ""), buckets=8)
    no_day, none = F.lit(None).cast("date"), F.lit(None).cast("long")

    def entry(name: str, table: str, key: str, *values):
        return store.read(made[table]).select(F.lit(name).alias("entry"), F.col(key).alias("key"), *values)

    days = ("first_release_date", "last_release_date")
    parts = (
        entry("discography", "artist_discography", "artist_id", "release_count", "country_count", "status_count", *days),
        entry("country", "country_metrics", "country", "artist_count", "release_count", "recording_count", no_day, no_day),
        entry("release", "release_metrics", "release_id", "recording_count", "url_count", F.col("release_year").cast("long"), no_day, no_day),
        entry("recording", "recording_metrics", "recording_id", "release_count", "artist_count", none, no_day, no_day),
    )
    out = entry("artist", "artist_metrics", "artist_id", "release_count", "album_count", "recording_count", *days)
    for part in parts:
        out = out.union(part)
    return out.toDF("entry", "key", "n1", "n2", "n3", "first_date", "last_date")
