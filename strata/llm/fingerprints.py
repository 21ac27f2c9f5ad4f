"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below ``1 / scale`` of the hash space, so its size
follows the document and sketches of very unequal documents estimate containment; the union
of two sketches is the sketch of both texts together.  A text of ``FEW`` shingles or less keeps them all, at
scale 1, and its fingerprint is marked; two sketches are compared at the lower of their thresholds.
A shingle is five words (all of a shorter text).

Where the smaller of two texts at hand is such a short one, few or none of its hashes lie below the threshold of
the longer: the likeness is then checked exactly, against all shingles of the longer text.

Defined results: a NULL text is empty; texts without words have an empty sketch, and
are alike to each other (1) and to nothing else (0); equal texts have equal
sketches; rows that repeat a ``doc_id`` stand in the order of their text hash; a
NULL ``doc_id`` stands last; the only document is its own next; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_or_empty

SHINGLE, SCALE, FEW = 5, 8, 64
MARK = "all:"  # of the fingerprint of a text that keeps every shingle
EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)
# Odd 64-bit constants of a multiplicative hash and its final mix.
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def shingle_hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of all shingles, from the hashes of their words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    each = np.array(list(map(xxhash.xxh3_64_intdigest, words)), dtype=np.uint64)
    k = min(shingle, len(words))
    n = len(words) - k + 1
    mixed = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        mixed = mixed * _STEP + each[i : i + n]
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX
    return mixed ^ (mixed >> np.uint64(29))


def below(hashes: np.ndarray, scale: int) -> np.ndarray:
    return hashes if scale == 1 else hashes[hashes < np.uint64((1 << 64) // scale)]


@dataclass(frozen=True)
class Sketch:
    """Sorted distinct hashes below ``1 / scale`` of the hash space."""

    hashes: np.ndarray
    scale: int

    def text(self) -> str:
        return (MARK if self.scale == 1 else "") + self.hashes.astype(">u8").tobytes().hex()


def sketch_of(shingles: np.ndarray, scale: int = SCALE) -> Sketch:
    """The sketch of the sorted distinct hashes of all shingles."""
    scale = 1 if len(shingles) <= FEW else scale
    return Sketch(below(shingles, scale), scale)


def sketch(text: str, scale: int = SCALE, shingle: int = SHINGLE) -> Sketch:
    return sketch_of(np.unique(shingle_hashes(text, shingle)), scale)


def merged(a: Sketch, b: Sketch, scale: int = SCALE) -> Sketch:
    """The sketch of two texts together (but for shingles across their seam)."""
    if a.scale == b.scale == 1:
        return sketch_of(np.union1d(a.hashes, b.hashes), scale)
    scale = max(a.scale, b.scale)
    return Sketch(np.union1d(below(a.hashes, scale), below(b.hashes, scale)), scale)


def _held(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def containment(a: Sketch, b: Sketch) -> float:
    """Share of the smaller sketch that the larger one holds, at the lower of their thresholds."""
    scale = max(a.scale, b.scale)
    return _held(below(a.hashes, scale), below(b.hashes, scale))


def likeness(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> float:
    """Containment from all shingles of two texts: exact where the smaller is short, else from their sketches."""
    if min(len(a), len(b)) <= FEW:
        return _held(a, b)
    return containment(sketch_of(a, scale), sketch_of(b, scale))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _neighbours(scale: int, shingle: int):
    """Rows of a range in their order, each with the one after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # (range, doc_id, text, shingles), still without its next
        for batch in batches:
            rows = []
            for part, guest, doc_id, value in zip(*(batch.column(i) for i in range(4))):
                part, guest, doc_id, text = part.as_py(), guest.as_py(), doc_id.as_py(), value.as_py()
                own = np.unique(shingle_hashes(text, shingle))
                if before is not None and before[0] == part:
                    _, last_id, last_text, last = before
                    new_text = edited(last_text, text)
                    new = np.unique(shingle_hashes(new_text, shingle))
                    rows.append(
                        (
                            last_id,
                            len(last_text),
                            hashlib.sha256(new_text.encode()).hexdigest(),
                            sketch_of(last, scale).text(),
                            sketch_of(new, scale).text(),
                            likeness(last, new, scale),
                            likeness(last, own, scale),
                        )
                    )
                before = None if guest else (part, doc_id, text, own)
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            columns = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in EDITED.split(",")]
            )

    return run


def edited_fingerprints(docs: DataFrame, scale: int = SCALE, shingle: int = SHINGLE, ranges: int | None = None) -> DataFrame:
    """Sketches of every text and of the text edited with the next document's
    beginning, in descending order of doc_id, and their likeness.

    Texts are shuffled once, into ranges of doc_id that tasks read in order.  The
    last document of a range needs the first of the next: those rows, one per
    range, go to both.  Only their ids pass through the driver.
    """
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = text_or_empty()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.col("doc_id").isNull().alias("k1"),
        F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(0).cast("long")).alias("k2"),
        F.xxhash64(text).alias("k3"),
    )
    share = [i / ranges for i in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("k2", share).alias("c")).first()["c"] if share else None
    cuts = sorted(set(cuts or ()))
    if cuts:
        bounds = F.array(*(F.lit(c).cast("long") for c in cuts))
        place = F.size(F.filter(bounds, lambda c: c < F.col("k2")))
    else:
        place = F.lit(0)
    # Documents without an id come last of all.
    rows = rows.withColumn("part", F.when(F.col("k1"), F.lit(len(cuts) + 1)).otherwise(place))
    heads = sorted(
        (r["part"], tuple(r["head"])) for r in rows.groupBy("part").agg(F.min(F.struct("k1", "k2", "k3")).alias("head")).collect()
    )
    guests = [(*heads[(i + 1) % len(heads)][1], heads[i][0]) for i in range(len(heads))]
    guests = spark.createDataFrame(guests, "g1 boolean, g2 long, g3 long, host int")
    met = (F.col("k1") == F.col("g1")) & (F.col("k2") == F.col("g2")) & (F.col("k3") == F.col("g3"))
    sent = rows.join(F.broadcast(guests), met, "left").select(
        F.inline(
            F.array_compact(
                F.array(
                    F.struct(F.col("part"), F.lit(False).alias("guest")),
                    F.when(F.col("host").isNotNull(), F.struct(F.col("host").alias("part"), F.lit(True).alias("guest"))),
                )
            )
        ),
        "doc_id",
        "text",
        "k1",
        "k2",
        "k3",
    )
    placed = sent.repartitionById(len(cuts) + 2, F.col("part")).sortWithinPartitions("part", "guest", "k1", "k2", "k3")
    return placed.select("part", "guest", "doc_id", "text").mapInArrow(_neighbours(scale, shingle), EDITED)
