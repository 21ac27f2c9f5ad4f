"""Curated tables kept up to date by the difference a batch makes.

``curate`` rebuilds every curated table from the whole of the sanitised tables.  ``maintain`` takes the
sanitised rows of the new batches only and passes signed differences on: what a release said before is
taken off, what it says now is added.  Distinct counts and first and last dates survive removals because
each is read out of a support table that counts how many releases speak for every value.

    release_children   (release, kind, child)                         which children a release has
    release_state      (release ...)                                  the release as last seen, its counts
    artist_support     (artist, group, date, country, status) -> n    releases that speak for these values
    recording_support  (recording, artist) -> n                       releases a recording is on

Every table is stored by bucket of its key and only hit buckets are read and written.  The support keys
carry a part, a hash of the value, so that no artist and no recording has to fit one bucket.

A batch is applied once, whenever the driver is lost: each step first writes the new rows of every key it
touches (``_after``), with what the next step needs, and only then replaces them in the table.  Replacing
twice changes nothing, and a finished step of an earlier attempt is taken up as it was written.
Of the tables of children and support, the largest, the whole of the hit buckets is written first, so that they are
shuffled once and replacing them is a copy.
Batches are to be maintained in the order they were loaded.  A NULL artist, group, date or country is a
value like any other, except that no artist metrics exist for a NULL artist.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.stamp import stamp_batch
from strata.operators.deltas import signed, signed_sum
from strata.plans.config import CURATED, Entity, Run
from strata.schemas import columns
from strata.session import discard, file_system
from strata.sinks.store import BUCKET, Store, TableDef
from strata.sources.tables import of_batches

PARTS = 8
RELEASE = ("artist_id", "group_id", "release_date", "country", "status")
SUPPORT = ("artist_id", "part", "group_id", "release_date", "country", "status")

_STATE = {
    "release_children": (columns("release_id string, part int, kind string, child_id string"), ("release_id", "part")),
    "release_state": (
        columns(
            "release_id string, artist_id string, group_id string, release_date date, country string,"
            " status string, known bool, recording_count long, url_count long"
        ),
        ("release_id",),
    ),
    "artist_support": (
        columns(
            "artist_id string, part int, group_id string, release_date date, country string, status string,"
            " n long, songs long"
        ),
        ("artist_id", "part"),
    ),
    "recording_support": (columns("recording_id string, part int, artist_id string, n long"), ("recording_id", "part")),
}


def maintained(buckets: int) -> dict[str, TableDef]:
    """The support tables and the curated tables made from them, in ``buckets`` buckets each."""
    state = {name: TableDef("state", name, cols, key, buckets) for name, (cols, key) in _STATE.items()}
    return state | {name: replace(t, schema_name="maintained", buckets=buckets) for name, t in CURATED.items()}


def _part(*value: str) -> Column:
    return F.pmod(F.hash(*value), F.lit(PARTS)).alias("part")


def _all_parts(keys: DataFrame) -> DataFrame:
    return keys.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in keys))


def _of_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of the given keys, NULL being one."""
    return rows.join(keys, _same(rows, keys, keys.columns), "left_semi")


def _together(*work: Callable) -> list:
    """Independent jobs at once, so that the last tasks of one leave no core idle."""
    with ThreadPoolExecutor(len(work)) as pool:
        return [done.result() for done in [pool.submit(w) for w in work]]


class _Step:
    """The written differences of one batch."""

    def __init__(self, store: Store, tables: dict[str, TableDef], run: Run):
        self.store, self.tables, self.run = store, tables, run
        self.root = f"{store.root}/state/after/batch_id={run.etl_batch_id}"

    def settle(self, name: str, make) -> DataFrame:
        """What ``make()`` gives, written once; a finished attempt is read as it is."""
        path = f"{self.root}/{name}"
        mark, files = file_system(self.store.spark, f"{path}/_SUCCESS")
        if not files.exists(mark):
            make().write.mode("overwrite").parquet(path)
        return self.store.spark.read.parquet(path)

    def held(self, name: str, keys: DataFrame) -> DataFrame:
        """Rows of the given table keys; only their buckets are read."""
        return _of_keys(self.store.rows_of_buckets(self.tables[name], keys), keys)

    def settle_buckets(self, name: str, new: DataFrame, how) -> DataFrame:
        """All rows of the buckets of the given table that ``new`` hits, as ``how(both)`` leaves them, written once.
        ``both`` has the held rows and the new ones, marked as ``_new``, dealt by the table's key.  Rows that
        ``how`` marks as ``_new`` are those the batch brought or changed."""
        table, path = self.tables[name], f"{self.root}/{name}"
        names = table.columns.fieldNames()

        def dealt(held: DataFrame, sent: DataFrame, tasks: int) -> DataFrame:
            both = held.select(*names, F.lit(False).alias("_new")).unionByName(sent.select(*names, F.lit(True).alias("_new")))
            rows = how(both.repartition(tasks, *table.key))
            return rows.select(*table.declared(rows), "_new")

        mark, files = file_system(self.store.spark, f"{path}/_SUCCESS")
        if not files.exists(mark):
            self.store.prepare_buckets(table, new, dealt, path)
        columns = [*table.columns, T.StructField("_new", T.BooleanType()), T.StructField(BUCKET, T.IntegerType())]
        return self.store.spark.read.schema(T.StructType(columns)).parquet(path)

    def now(self, name: str, settled: DataFrame, keys: DataFrame) -> DataFrame:
        """Rows of the buckets of all parts of the given keys as the batch leaves them: ``settled`` has those of the
        buckets it hits, the table those of the others."""
        table = self.tables[name]
        hit, wanted = self.store.buckets_of(f"{self.root}/{name}"), self.store.hit(table, _all_parts(keys))
        others = self.store.rows_of(table, sorted(set(wanted) - set(hit))).withColumn("_new", F.lit(False))
        return settled.where(F.col(BUCKET).isin(wanted)).drop(BUCKET).unionByName(others)

    def held_parts(self, name: str, keys: DataFrame) -> DataFrame:
        """Rows of all parts of the given keys; only their buckets are read."""
        return _of_keys(self.store.rows_of_buckets(self.tables[name], _all_parts(keys)), keys)

    def put(self, name: str, after: DataFrame, keep: Column) -> None:
        """Replace the rows of all keys in ``after`` by those of its rows that ``keep`` holds for.  Held and new
        rows are shuffled together, once."""
        table = self.tables[name]
        rows = after.withColumn("_keep", keep)
        names = table.columns.fieldNames()

        def how(held: DataFrame, new: DataFrame) -> DataFrame:
            was = held.select(*names, F.lit(False).alias("_new"), F.lit(True).alias("_keep"))
            both = was.unionByName(new.select(*names, F.lit(True).alias("_new"), "_keep"))
            both = both.repartition(table.tasks(held, new), *table.key)
            hit = F.max("_new").over(Window.partitionBy(*table.key))
            return both.withColumn("_hit", hit).where("_keep AND (_new OR NOT _hit)").select(*names)

        self.store.merge(table, rows, how)


def _contribution(releases: DataFrame) -> DataFrame:
    """What each release adds to its artist's support."""
    return releases.where("known").select(
        *RELEASE, _part("group_id", "release_date"), F.lit(1).cast("long").alias("n"), F.col("recording_count").alias("songs")
    )


def _appearances(children: DataFrame, releases: DataFrame) -> DataFrame:
    """One row per release that a recording is on, with the release's artist."""
    of = releases.select("release_id", F.col("artist_id").alias("artist_id"))
    on = children.where(F.col("kind") == "recording").select("release_id", F.col("child_id").alias("recording_id"))
    rows = on.join(of, "release_id", "left")
    return rows.select("recording_id", _part("artist_id"), "artist_id", F.lit(1).cast("long").alias("n"))


def _new_children(step: _Step, recordings: DataFrame, urls: DataFrame) -> DataFrame:
    """Children of the buckets that the batch hits; ``_new`` are those that their release did not have before."""
    sent = recordings.select("release_id", F.lit("recording").alias("kind"), F.col("recording_id").alias("child_id"))
    sent = sent.unionByName(urls.select("release_id", F.lit("url").alias("kind"), F.col("url_id").alias("child_id")))
    sent = sent.select("release_id", _part("child_id"), "kind", "child_id")
    names = sent.columns

    def once(both: DataFrame) -> DataFrame:
        rows = both.groupBy(*names).agg(F.max("_new").alias("_sent"), (~F.min("_new")).alias("_held"))
        unknown = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in names))  # never the same as a held one
        return rows.select(*names, (F.col("_sent") & (~F.col("_held") | unknown)).alias("_new"))

    return step.settle_buckets("release_children", sent, once)


def _releases_after(step: _Step, releases: DataFrame, children: DataFrame) -> DataFrame:
    """Releases the batch touches, as they are now (``now``) and as they were (``was``, NULL if new)."""
    counts = children.groupBy("release_id").agg(
        F.count_if(F.col("kind") == "recording").alias("more_recordings"), F.count_if(F.col("kind") == "url").alias("more_urls")
    )
    sent = releases.select("release_id", F.struct(*RELEASE).alias("sent"))
    touched = sent.join(counts, "release_id", "full_outer")
    keys = releases.select("release_id").union(children.select("release_id"))
    old = step.store.rows_of_buckets(step.tables["release_state"], keys)  # the join below takes the touched ones
    old = old.select("release_id", F.struct(*old.columns).alias("was"))

    def value(name: str) -> Column:
        return F.when(F.col("sent").isNotNull(), F.col(f"sent.{name}")).otherwise(F.col(f"was.{name}")).alias(name)

    def total(name: str, more: str) -> Column:
        return (F.coalesce(f"was.{name}", F.lit(0)) + F.coalesce(more, F.lit(0))).cast("long").alias(name)

    now = F.struct(
        "release_id",
        *(value(c) for c in RELEASE),
        (F.col("sent").isNotNull() | F.coalesce("was.known", F.lit(False))).alias("known"),
        total("recording_count", "more_recordings"),
        total("url_count", "more_urls"),
    )
    return touched.join(old, "release_id", "left").select(now.alias("now"), "was")


def _support_after(step: _Step, name: str, delta: DataFrame, sums: Sequence[str]) -> DataFrame:
    """All support rows of the buckets the delta touches, those it changes marked as ``_new``; a row whose counts
    are zero stands for a value that nothing speaks for any more."""
    values = [c for c in step.tables[name].columns.fieldNames() if c not in sums]

    def added(both: DataFrame) -> DataFrame:
        return both.groupBy(*values).agg(*(F.sum(c).alias(c) for c in sums), F.max("_new").alias("_new"))

    return step.settle_buckets(name, delta, added)


def _artist_rows(artists: DataFrame, support: DataFrame) -> DataFrame:
    """Metrics and discography of the given artists out of their support."""
    albums = support.groupBy("artist_id", "group_id", "country", "status").agg(
        F.sum("n").alias("n"),
        F.sum("songs").alias("songs"),
        F.min("release_date").alias("first"),
        F.max("release_date").alias("last"),
    )
    per_artist = albums.groupBy("artist_id").agg(
        F.sum("n").alias("release_count"),
        F.count_distinct("group_id").alias("album_count"),
        F.sum("songs").alias("recording_count"),
        F.min("first").alias("first_release_date"),
        F.max("last").alias("last_release_date"),
        F.count_distinct("country").alias("country_count"),
        F.count_distinct("status").alias("status_count"),
    )
    counts = [c for c in per_artist.columns if c.endswith("_count")]
    return artists.join(per_artist, "artist_id", "left").na.fill(0, counts)


def maintain(store: Store, entities: dict[str, Entity], run: Run, buckets: int, batches: Sequence[str] = ()) -> dict[str, TableDef]:
    """Bring the maintained tables up to date with the sanitised rows of ``batches`` (the run's own
    when none is given).  Returns the tables; the first batch builds them."""
    tables = maintained(buckets)
    for table in tables.values():
        store.create_if_absent(table)
    step = _Step(store, tables, run)
    if step_done(step):
        return tables
    batches = list(batches) or [run.etl_batch_id]
    artists, releases, recordings, urls = (
        of_batches(store.read(entities[n].sanitised), batches) for n in ("artists", "releases", "recordings", "urls")
    )

    # Releases and their children.
    all_children = _new_children(step, recordings, urls)
    children = all_children.where("_new").drop("_new", BUCKET)
    pairs = step.settle("releases", lambda: _releases_after(step, releases, children))
    now, was = pairs.select("now.*"), pairs.where(F.col("was").isNotNull()).select("was.*")

    def contributions() -> DataFrame:
        return signed(_contribution(was), _contribution(now), SUPPORT, ("n", "songs"))

    def appearances() -> DataFrame:
        """Recordings of releases that changed their artist, and new ones."""
        moved = pairs.where(F.col("was").isNotNull() & ~F.col("was.artist_id").eqNullSafe(F.col("now.artist_id")))
        before = step.held_parts("release_children", moved.select(F.col("now.release_id").alias("release_id")))
        new = _appearances(children, now).unionByName(_appearances(before, now))
        return signed(_appearances(before, was), new, ("recording_id", "part", "artist_id"), ("n",))

    artist_delta, recording_delta = _together(
        lambda: step.settle("artist_delta", contributions), lambda: step.settle("recording_delta", appearances)
    )

    # Support, and what is read out of it.
    artist_support, recording_support = _together(
        lambda: _support_after(step, "artist_support", artist_delta, ("n", "songs")),
        lambda: _support_after(step, "recording_support", recording_delta, ("n",)),
    )

    def artist_rows() -> DataFrame:
        """Of whole artists, out of their support as it is now."""
        touched = artist_delta.select("artist_id").union(artists.select("artist_id")).where(F.col("artist_id").isNotNull()).distinct()
        known = store.rows_of_buckets(entities["artists"].sanitised, touched).select("artist_id", "name", "country")
        support = step.now("artist_support", artist_support, touched).where("n <> 0").drop("_new")
        # No NULL is among the touched, so plain joins do, and what follows is grouped as they deal it.
        return _artist_rows(known.join(touched, "artist_id", "left_semi"), support.join(touched, "artist_id", "left_semi"))

    def recording_rows() -> DataFrame:
        """Of whole recordings likewise."""
        support = step.now("recording_support", recording_support, recording_delta.select("recording_id"))
        rows = support.groupBy("recording_id").agg(
            F.sum("n").alias("release_count"),
            F.count_if((F.col("n") != 0) & F.col("artist_id").isNotNull()).alias("artist_count"),
            F.max("_new").alias("hit"),
        )
        return rows.where("hit").drop("hit")

    artist_now, recording_now = _together(
        lambda: step.settle("artist_rows", artist_rows), lambda: step.settle("recording_rows", recording_rows)
    )

    # Countries: the differences of their artists.
    sums = ("artist_count", "release_count", "recording_count")

    def per_country(rows: DataFrame) -> DataFrame:
        return rows.select("country", F.lit(1).cast("long").alias("artist_count"), "release_count", "recording_count")

    def countries() -> DataFrame:
        old = step.held("artist_metrics", artist_now.select("artist_id"))
        delta = signed(per_country(old), per_country(artist_now), ("country",), sums)
        held = step.held("country_metrics", delta.select("country"))
        return signed_sum(held.select("country", *sums).unionByName(delta), ("country",), sums, keep_zero=True)

    country_now = step.settle("countries", countries)

    # Nothing above has changed a table.
    everything, batch = F.lit(True), run.etl_batch_id
    per_release = now.withColumn("release_year", F.year("release_date"))
    replaced = {
        "release_state": (now, everything),
        "release_metrics": (stamp_batch(per_release, batch), F.col("known")),
        "artist_metrics": (stamp_batch(artist_now, batch), everything),
        "artist_discography": (stamp_batch(artist_now, batch), everything),
        "recording_metrics": (stamp_batch(recording_now, batch), F.col("release_count") > 0),
        "country_metrics": (stamp_batch(country_now, batch), F.col("artist_count") > 0),
    }
    settled = {"release_children": all_children, "artist_support": artist_support.where("n <> 0"), "recording_support": recording_support.where("n <> 0")}
    copied = (lambda name=name, rows=rows: store.replace_buckets(tables[name], f"{step.root}/{name}", rows) for name, rows in settled.items())
    _together(*copied, *(lambda name=name, rows=rows: step.put(name, *rows) for name, rows in replaced.items()))
    finish(step)
    return tables


def step_done(step: _Step) -> bool:
    mark, files = file_system(step.store.spark, f"{step.store.root}/state/done/{step.run.etl_batch_id}")
    return files.exists(mark)


def finish(step: _Step) -> None:
    """Note the batch as applied, then drop its written differences."""
    mark, files = file_system(step.store.spark, f"{step.store.root}/state/done/{step.run.etl_batch_id}")
    files.mkdirs(mark)
    discard(step.store.spark, step.root)
