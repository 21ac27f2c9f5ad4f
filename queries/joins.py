"""Response filters, expansions and hierarchy joins."""

from pyspark.sql import functions as F

from queries.registry import Tables, query
from strata.functions import payload as P
from strata.operators import expand, filters, relate
from strata.operators.fold import top_n
from strata.operators.hot import watch_keys
from strata.operators.skew import lookup_join
from strata.session import settle, spread, work_path


def _responses(t: Tables):
    """Events as captured responses: one run per user, 'error' events failed."""
    return t.events.select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("ord"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
        "value",
    )


@query(
    """
    SELECT user_id AS run_id, event_id AS ord, 200 AS status_code, value FROM events
    WHERE event_type <> 'error'
    """
)
def responses_ok(t: Tables):
    """Successful responses; failed ones are skipped."""
    return filters.split_successful(_responses(t))[0]


@query(
    """
    SELECT event_id AS ord, 'status 500' AS reject_reason FROM events WHERE event_type = 'error'
    """
)
def responses_failed(t: Tables):
    """The failed responses, kept aside with a reason."""
    return filters.split_successful(_responses(t))[1].select("ord", "reject_reason")


@query(
    """
    WITH f AS (SELECT user_id, min(event_id) AS first FROM events WHERE event_type = 'error' GROUP BY 1)
    SELECT e.user_id AS run_id, e.event_id AS ord, 200 AS status_code, e.value
    FROM events e LEFT JOIN f ON e.user_id = f.user_id
    WHERE f.first IS NULL OR e.event_id < f.first
    """
)
def responses_prefix(t: Tables):
    """Responses of each run up to its first failure."""
    return filters.before_first_failure(_responses(t))


@query(
    """
    SELECT p_partkey, p_name FROM part WHERE lower(trim(p_name)) IN ('small ring', 'red widget', 'blue bolt')
    """
)
def search_terms(t: Tables):
    """Entities named by a search list, ignoring case and outer blanks."""
    terms = t.spark.createDataFrame([("Small Ring",), (" RED widget ",), ("blue bolt",)], "term string")
    return filters.match_terms(t.part, terms, "p_name").select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%ring%' OR lower(p_name) LIKE '%blue%'")
def search_terms_contained(t: Tables):
    """Entities whose name contains a search term."""
    return filters.containing_terms(t.part, ["Ring", " blue"], "p_name").select("p_partkey", "p_name")


@query("SELECT count(*) AS n_children FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 1e12")
def empty_guard(t: Tables):
    """No parents, so no children: an empty input flows through the expansion."""
    parents = t.customer.where(F.col("c_acctbal") > 1e12).select(F.col("c_custkey").alias("id"))
    return expand.expand_children(parents, _releases_of(t), "releases").agg(
        F.count("*").alias("n_children")
    )


def _releases_of(t: Tables):
    """Release responses per customer, each with the order in its envelope."""
    release = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
    )
    return spread(t.orders).select(
        F.col("o_custkey").alias("request_key"),
        F.to_json(F.struct(F.array(release).alias("releases"))).alias("body"),
    )


@query(
    """
    SELECT c_custkey AS artist_id, o_orderkey AS release_id, o_orderstatus AS status,
           o_orderdate::date AS release_date
    FROM customer JOIN orders ON c_custkey = o_custkey
    """
)
def expand_children(t: Tables):
    """Releases found in the responses requested for each artist."""
    parents = t.customer.select(F.col("c_custkey").alias("id"))
    rows = expand.expand_children(parents, _releases_of(t), "releases")
    release = F.from_json("element", "id bigint, status string, date string")
    return rows.select(F.col("parent_id").alias("artist_id"), release.alias("r")).select(
        "artist_id",
        F.col("r.id").alias("release_id"),
        "r.status",
        F.try_to_date("r.date", "yyyy-MM-dd").alias("release_date"),
    )


@query(
    """
    SELECT o_orderkey AS id, l_linenumber AS line, l_quantity AS quantity
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag <> 'R'
    """
)
def detail_ok(t: Tables):
    """Detail per release; only successful responses survive."""
    details = t.lineitem.select(
        F.col("l_orderkey").alias("request_key"),
        F.when(F.col("l_returnflag") == "R", 404).otherwise(200).alias("status_code"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"),
    )
    parents = t.orders.select(F.col("o_orderkey").alias("id"))
    return expand.detail_ok(parents, details).select("id", "line", "quantity")


@query(
    """
    SELECT d.doc_id AS id, CASE WHEN toxic = 1 THEN 500 WHEN toxic = 0 THEN 200 END AS status_code, quality
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """
)
def detail_keep_errors(t: Tables):
    """Detail per release with error bodies kept, and releases without one too."""
    details = t.labels.select(
        F.col("doc_id").alias("request_key"),
        F.when(F.col("toxic") == 1, 500).otherwise(200).alias("status_code"),
        "quality",
    )
    parents = t.documents.select(F.col("doc_id").alias("id"))
    return expand.detail_keep_errors(parents, details).select("id", "status_code", "quality")


@query(
    """
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1
    """
)
def top1_per_key(t: Tables):
    """Best match per request."""
    rank = [F.desc("o_totalprice"), F.col("o_orderkey")]
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return expand.best_matches(rows, ["o_custkey"], rank)


@query(
    """
    SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_suppkey
      ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) <= 100
    """
)
def top100_per_key(t: Tables):
    """First hundred results per request."""
    cols = ["l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    rank = [F.desc("l_extendedprice"), *(F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey"))]
    return top_n(t.lineitem.select(*cols), ["l_suppkey"], rank, 100)


@query(
    """
    SELECT n_name AS artist_name, c_name AS album_name, o_orderdate AS release_date
    FROM nation JOIN customer ON n_nationkey = c_nationkey JOIN orders ON c_custkey = o_custkey
    """
)
def three_way_groups(t: Tables):
    """Artist, album and release: nations, their customers, the orders of those."""
    artists = t.nation.select(F.col("n_nationkey").alias("artist_id"), F.col("n_name").alias("name"))
    groups = t.customer.select(
        F.col("c_nationkey").alias("artist_id"), F.col("c_custkey").alias("group_id"), F.col("c_name").alias("title")
    )
    releases = t.orders.select(F.col("o_custkey").alias("group_id"), F.col("o_orderdate").alias("release_date"))
    return relate.artist_albums(artists, groups, releases)


@query(
    """
    SELECT c_custkey AS artist_id, c_name AS name, o_orderkey AS release_id, o_orderpriority AS title,
           l_partkey AS recording_id, l_linenumber AS song_name
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
    """
)
def three_way_songs(t: Tables):
    """Artist, release and recording."""
    return relate.artist_songs(t.artists, t.releases, t.recordings)


def bridge_of_events(t: Tables):
    events = P.parsed(spread(t.events.select("user_id", "event_type", "props")), "props")
    tagged = events.select(
        F.col("user_id").alias("artist_id"),
        F.array(
            F.struct(F.col("event_type").alias("name")),
            F.struct(F.concat(F.lit("k"), P.get(F.col("v"), "$.k")).alias("name")),
        ).alias("tags"),
    )
    return relate.tag_bridge(tagged, tag=F.col("x.name"))


_BRIDGE = """
    SELECT DISTINCT user_id AS artist_id, tag_name FROM (
      SELECT user_id, event_type AS tag_name FROM events
      UNION ALL SELECT user_id, 'k' || (props->>'k') FROM events)
"""


@query(_BRIDGE)
def tag_bridge(t: Tables):
    """Distinct artist-to-tag pairs out of nested tag lists."""
    return bridge_of_events(t)


@query(
    f"""
    SELECT b.artist_id, c_name AS name, c_nationkey AS country, b.tag_name
    FROM ({_BRIDGE}) b JOIN customer ON c_custkey = b.artist_id
    WHERE b.tag_name IN (SELECT event_type FROM events)
    """
)
def tagged_artists(t: Tables):
    """Both sides of the many-to-many relation through the bridge."""
    tags = t.events.select(F.col("event_type").alias("tag_name")).distinct()
    return relate.tagged_artists(t.artists, bridge_of_events(t), tags)


@query(
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, s_name FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
    """
)
def watched_lookup(t: Tables):
    """Line items with their suppliers; the hot suppliers are known from writing the line items."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    watched, hot = watch_keys(rows, "suppliers", ["l_suppkey"])
    written = settle(watched, work_path(t.spark, "watched"))
    lookup = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    least = max(1, written.count() // 200)
    return lookup_join(written, lookup, ["l_suppkey"], "left", ["l_orderkey", "l_linenumber"], hot=hot(least))
