"""Curation stage: sanitised tables to curated tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from strata.functions.stamp import stamp_batch
from strata.operators import curated as A
from strata.plans.config import CURATED, Entity, Run
from strata.sinks.store import Store


def curate(store: Store, entities: dict[str, Entity], run: Run) -> list[str]:
    """Rebuild every curated table, stamped with the run's batch; returns their names.

    Recordings, the largest input, are counted per release once: the artist
    metrics read the counts out of the published release metrics, and the country
    metrics are a roll-up of the published artist metrics.
    """
    artists, releases, recordings, urls = (
        store.read(entities[n].sanitised) for n in ("artists", "releases", "recordings", "urls")
    )
    def publish(name: str, rows: DataFrame) -> DataFrame:
        store.refresh(CURATED[name], stamp_batch(rows, run.etl_batch_id), run.etl_batch_id)
        return store.read(CURATED[name])

    def counts() -> None:
        per_release = publish("release_metrics", A.release_metrics(releases, recordings, urls))
        per_artist = publish("artist_metrics", A.artist_metrics(artists, releases, per_release))
        publish("country_metrics", A.country_metrics(per_artist))

    # Three independent chains of jobs, so one chain's last tasks leave no core idle.
    chains = (
        counts,
        lambda: publish("recording_metrics", A.recording_metrics(releases, recordings)),
        lambda: publish("artist_discography", A.discography(artists, releases)),
    )
    with ThreadPoolExecutor(len(chains)) as pool:
        for done in [pool.submit(chain) for chain in chains]:
            done.result()
    return list(CURATED)
