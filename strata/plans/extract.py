"""Extraction: captured responses to raw snapshots, parents driving children."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import payload as P
from strata.operators import filters
from strata.operators.expand import best_matches, detail_keep_errors, detail_ok, expand_children
from strata.operators.project import keys_of
from strata.plans.config import Run
from strata.sinks.snapshots import write_snapshot
from strata.sources.responses import unwrap_envelope
from strata.sources.snapshots import read_json_lines

SKIP, STOP = "skip", "stop"
ORDER = ("ord", "pos")


@dataclass(frozen=True)
class Limits:
    """How failures end a request loop, and result caps per request (None: all).

    A cap is an answer the caller asks for (the best match of a search, one browse
    page); none is set by default.
    """

    on_failure: str = SKIP
    artists_per_search: int | None = None
    releases_per_artist: int | None = None


DAILY_RUN = Limits()


def split_usable(responses: DataFrame, on_failure: str) -> tuple[DataFrame, DataFrame]:
    """(responses a request loop keeps, the others with a reason): all good ones, or
    those before the first that failed or cannot be read."""
    if on_failure == STOP:
        return filters.split_at_first_failure(responses, body="body")
    return filters.split_successful(responses)


def usable(responses: DataFrame, on_failure: str) -> DataFrame:
    return split_usable(responses, on_failure)[0]


def _capped(items: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` results of each request; requests of two runs are two requests."""
    request = ["run_id", "request_key"] if "run_id" in items.columns else ["request_key"]
    return items if n is None else best_matches(items, request, [F.col(c) for c in ORDER], n)


def search_artists(responses: DataFrame, limits: Limits, terms: DataFrame | None = None) -> DataFrame:
    """Artists found by the searches, all of them or those of a term list."""
    hits = usable(responses, limits.on_failure)
    if terms is not None:
        hits = filters.match_terms(hits, terms, "request_key")
    items = unwrap_envelope(hits, "artists")
    return _capped(items, limits.artists_per_search).select("request_key", *ORDER, "element")


def browse_releases(artists: DataFrame, responses: DataFrame, limits: Limits) -> DataFrame:
    """Releases of each artist, with the artist's key put into the object."""
    items = expand_children(artists, usable(responses, limits.on_failure), "releases")
    return _capped(items, limits.releases_per_artist).select(
        "request_key", *ORDER, P.with_field(F.col("element"), "artist_id", F.col("request_key")).alias("element")
    )


def recording_bodies(releases: DataFrame, responses: DataFrame) -> DataFrame:
    """Release bodies with their recordings; only successful responses."""
    return detail_ok(releases, responses).select(
        "request_key", "ord", F.lit(0).alias("pos"), F.col("body").alias("element")
    )


def url_bodies(releases: DataFrame, responses: DataFrame) -> DataFrame:
    """Release bodies with their urls; error bodies are kept as they came."""
    kept = detail_keep_errors(releases, responses).where(F.col("body").isNotNull())
    return kept.select("request_key", "ord", F.lit(0).alias("pos"), F.col("body").alias("element"))


def extract(
    responses: DataFrame,
    run: Run,
    limits: Limits = DAILY_RUN,
    terms: DataFrame | None = None,
    captured: str | None = None,
) -> dict[str, str]:
    """Write the snapshots of all entities for the run's day; returns their paths.

    ``captured`` names the captured run to take; without it all rows are taken, so
    the caller gives the responses of one run.  Each step reads the keys of the one
    before from its written snapshot.  No parents means empty child snapshots.
    ``unused_responses`` has what the searches and browses leave out.
    """
    spark = responses.sparkSession
    paths: dict[str, str] = {}
    if captured is not None:
        responses = responses.where(F.col("run_id") == captured)

    def of(endpoint: str) -> DataFrame:
        return responses.where(F.col("endpoint") == endpoint)

    def write(source: str, items: DataFrame) -> DataFrame:
        folder = f"{run.raw_root}/{source}"
        paths[source] = write_snapshot(items, folder, source, run.day, order=ORDER)
        written = read_json_lines(spark, paths[source])
        found = P.parsed(written.select("element"), "element")
        return keys_of(found.select(P.get(F.col("v"), "$.id").alias("id"))).distinct()

    artists = write("artists", search_artists(of("artist"), limits, terms))
    releases = write("releases", browse_releases(artists, of("release"), limits))
    write("recordings", recording_bodies(releases, of("release+recordings")))
    write("urls", url_bodies(releases, of("release+url-rels")))
    return paths


def unused_responses(responses: DataFrame, limits: Limits) -> DataFrame:
    """Searches and browses that a run with these limits leaves out, each with its reason."""
    of = [split_usable(responses.where(F.col("endpoint") == e), limits.on_failure)[1] for e in ("artist", "release")]
    return of[0].unionByName(of[1])
