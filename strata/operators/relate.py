"""Joins along the entity hierarchy, and key-level checks between tables.

Canonical columns: artists(artist_id, name, country), release_groups(group_id,
artist_id, title), releases(release_id, artist_id, group_id, title, release_date,
country, status), recordings(recording_id, release_id, song_name), urls(url_id,
release_id).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.skew import lookup_join


def artist_albums(artists: DataFrame, groups: DataFrame, releases: DataFrame) -> DataFrame:
    """Artist, album name and release date of every release of every album."""
    return (
        artists.select("artist_id", F.col("name").alias("artist_name"))
        .join(groups.select("artist_id", "group_id", F.col("title").alias("album_name")), "artist_id")
        .join(releases.select("group_id", "release_date"), "group_id")
        .select("artist_name", "album_name", "release_date")
    )


def artist_songs(artists: DataFrame, releases: DataFrame, recordings: DataFrame) -> DataFrame:
    """One row per recording of every release of every artist."""
    return (
        artists.select("artist_id", "name")
        .join(releases.select("artist_id", "release_id", "title"), "artist_id")
        .join(recordings.select("release_id", "recording_id", "song_name"), "release_id")
        .select("artist_id", "name", "release_id", "title", "recording_id", "song_name")
    )


def tag_bridge(artists: DataFrame, tags: str = "tags", tag: Column | None = None) -> DataFrame:
    """Distinct (artist_id, tag_name) pairs of an array column.

    ``tag`` picks the name out of an element ``x`` that is not the name itself.
    """
    rows = artists.select("artist_id", F.explode(tags).alias("x"))
    return rows.select("artist_id", (F.col("x") if tag is None else tag).alias("tag_name")).distinct()


def tagged_artists(artists: DataFrame, bridge: DataFrame, tags: DataFrame) -> DataFrame:
    """Artists with the tags they carry, through the bridge; one tag may be on most."""
    carried = lookup_join(bridge, tags, ["tag_name"], "inner", ["artist_id"])
    return carried.join(artists, "artist_id")


def lost_records(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the source that the target does not hold."""
    wanted = source.select(*keys).distinct()
    return wanted.join(target.select(*keys).distinct(), list(keys), "left_anti")


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Foreign keys without a parent and the number of child rows that hold them.

    Child rows are counted per key first, so only one row per key is joined.
    """
    held = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n_rows"))
    return held.join(
        parent.select(F.col(pk).alias(fk)).distinct(), fk, "left_anti"
    )


def orphan_rows(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """The child rows themselves whose parent is missing."""
    return child.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti").where(F.col(fk).isNotNull())


def broken_chains(
    root: DataFrame, root_id: str, levels: Sequence[tuple[str, DataFrame, str, str]], hot: Sequence[Sequence[int]] | None = None
) -> DataFrame:
    """Every row below a missing parent, with the row that lacks it.

    ``levels`` go down from the root: (name, rows, their id, their foreign key to the level above).  A row whose
    key has no parent is broken at distance 0 and names itself; a row below it is broken as well, one further
    away, and names the same.  Columns: level, id, fk, broken_level, broken_id, distance.

    A level costs one join, which splits hot foreign keys; ``hot`` may give these per level (see ``hot``).  A row
    without a foreign key is taken as unbroken.  Where an id stands on several rows, rows below it are
    unbroken if one of these is, else they name the first of their broken ancestors.  Ids are compared as text.
    """
    healthy = F.lit(None).cast("struct<broken_level:string,broken_id:string,distance:int>")
    above = root.select(F.col(root_id).cast("string").alias("fk")).distinct().select("fk", healthy.alias("up"), F.lit(True).alias("held"))
    found = []
    for n, (name, rows, own, fk) in enumerate(levels):
        keyed = rows.select(F.col(own).cast("string").alias("id"), F.col(fk).cast("string").alias("fk"))
        met = lookup_join(keyed, above, ["fk"], "left", ["id"], hot=hot[n] if hot else None)
        itself = F.struct(F.lit(name).alias("broken_level"), F.col("id").alias("broken_id"), F.lit(0).alias("distance"))
        below = F.col("up").withField("distance", F.col("up.distance") + 1)
        at = F.when(F.col("fk").isNull(), healthy).when(F.col("held").isNull(), itself).otherwise(below)
        met = met.select("id", "fk", at.alias("up"))
        found.append(met.where(F.col("up").isNotNull()).select(F.lit(name).alias("level"), "id", "fk", "up.*"))
        if n + 1 < len(levels):
            one = F.when(F.bool_and(F.col("up").isNotNull()), F.min("up")).alias("up")
            above = met.groupBy(F.col("id").alias("fk")).agg(one).withColumn("held", F.lit(True))
    return reduce(DataFrame.unionByName, found)
