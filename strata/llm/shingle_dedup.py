"""Near duplicates by exact likeness: texts whose sets of word shingles are alike.

Two texts are linked when the Jaccard similarity of their sets of five-word shingles is ``ALIKE`` or more.

First by SimHash: every set has a 64-bit fingerprint, and sets whose fingerprints differ in at most four bits are
found over blocks, in crowds through the words half way (see ``simhash``), verified by their shingles and linked.
At a similarity of 0.8 some 10 of 64 bits differ, give or take 6, and blocks that any two fingerprints 16 bits apart
share are too short to tell texts apart.  So texts that SimHash leaves apart are then compared by minima: candidates
are texts that agree in a band; with 20 bands of 5 a pair at 0.8 is missed with a chance of 0.0004, a closer one with
less.  Candidates whose signatures cannot belong to such a pair (at 0.8 that happens with a chance of 0.002) go before
any text is moved; every other is verified by its shingles.  Equal sets are one node, so copies are never paired.

A band that more than ``crowd`` nodes share is not joined with itself.  In rounds, its heaviest nodes
(those that share most in all their bands, as the original of a family does) are the centres: all others are
compared with them, by signatures first and, where these agree, by shingles.  A centre that has met all others
is done and leaves the band; a band whose nodes are all linked already is done as a whole.  The rounds go on, with
more centres each, until every band is done, so no pair is passed over for the size of its band.  Groups that hang
together take a round or two; only bands of many nodes that are not alike cost a comparison of signatures a pair.
Two nodes that share several crowded bands are compared in the first of these alone, once one of them is a centre
there, so no pair is made twice.
A round's links join the groups found before, so only the groups they touch are worked on again.

Defined results: words and lower case as in ``simhash``; fewer words than five are one
shingle; NULL, empty and blank texts are copies of each other; repeated rows and rows without a ``doc_id`` are
marked like all others; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import simhash
from strata.llm.common import text_or_empty
from strata.llm.components import component_roots
from strata.session import discard, settle, work_path

SHINGLE, ALIKE, BANDS, ROWS, CROWD, SEED = 5, (4, 5), 20, 5, 8, 42
MINIMA = 200  # of a signature, a byte each; the first BANDS * ROWS make the bands
PLAUSIBLE = 0.71  # equal bytes of two signatures; at 0.8 a pair falls short with a chance of 0.002
CENTRES, MORE, MOST = 4, 128, 512  # centres of a band in the first round, times as many in each further one, at most
_STEP = 1 << 12  # shingles multiplied at a time
_KEPT = 64  # shingle sets a task keeps for the next pairs
_PART = 4096  # nodes of a band that one group compares
_CELLS = 1 << 25  # bytes of signatures compared at a time


def shingles(text: bytes) -> np.ndarray:
    """Sorted different hashes of the shingles of a UTF-8 text."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(size + 1) - 1
    spans = zip((ends - size).tolist(), ends[min(SHINGLE, len(words)) - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[a:b], SEED) for a, b in spans], dtype=np.uint64))


def minima(found: np.ndarray) -> np.ndarray:
    """The least value of the shingles under each of ``MINIMA`` hash functions."""
    draw = np.random.default_rng(SEED)
    by = draw.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), _STEP):
        part = found[at : at + _STEP, None] * by[None, :]
        np.minimum(least, (part ^ (part >> np.uint64(32))).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> list[int]:
    """One signed key per band."""
    bands = least[: BANDS * ROWS].reshape(BANDS, ROWS)
    keys = [xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(bands)]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def signature(least: np.ndarray) -> bytes:
    return ((least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8).tobytes()


def fingerprint(found: np.ndarray) -> int:
    """SimHash of a set of shingles."""
    return simhash.of_hashes(found[at : at + _STEP] for at in range(0, len(found), _STEP))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return ALIKE[1] * common >= ALIKE[0] * (len(a) + len(b) - common)


MARKED = "doc_id long, text_hash long, node binary, keys array<long>, signature binary, fp long"
LINKS = "a binary, b binary, la binary, lb binary"  # two nodes and the groups they were in when they met


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(t.as_py()) for t in batch.column(1)]
        least = [minima(f) if len(f) else None for f in found]
        columns = [
            batch.column(0),
            batch.column(2),
            pa.array([xxhash.xxh3_128_digest(f.tobytes()) for f in found], pa.binary()),
            pa.array([[] if x is None else band_keys(x) for x in least], pa.list_(pa.int64())),
            pa.array([b"" if x is None else signature(x) for x in least], pa.binary()),
            pa.array(np.array([fingerprint(f) for f in found], dtype=np.uint64).view(np.int64)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "node", "keys", "signature", "fp"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: dict[bytes, np.ndarray] = {}

    def of(node: bytes, text) -> np.ndarray:
        if node not in kept:
            if len(kept) == _KEPT:
                del kept[next(iter(kept))]
            kept[node] = shingles(text.as_py())
        return kept[node]

    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        same = [alike(of(x, s), of(y, t)) for x, y, s, t in zip(a, b, batch.column(4), batch.column(5))]
        yield batch.select([0, 1, 2, 3]).filter(pa.array(same, pa.bool_()))


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b, signatures of both) that may be alike."""
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, MINIMA) for i in (2, 3))
        yield batch.select([0, 1]).filter(pa.array((x == y).sum(axis=1) >= PLAUSIBLE * MINIMA))


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (node, centre) of a group that may be alike, are not linked yet and share no crowded band before this
    one; a group's centres come first."""
    group, nodes, labels, shared, table = None, [], [], [], np.zeros((0, MINIMA), dtype=np.uint8)
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()))
        node, label, drawn = (batch.column(i).to_pylist() for i in (3, 4, 5))
        crowds = [frozenset(c) for c in batch.column(6).to_pylist()]
        at = 0
        while at < len(keys):
            upto = at
            while upto < len(keys) and keys[upto] == keys[at]:
                upto += 1
            part = np.frombuffer(b"".join(drawn[at:upto]), dtype=np.uint8).reshape(-1, MINIMA)
            if keys[at][:2] != group:
                group, nodes, labels, shared, table = keys[at][:2], [], [], [], part[:0]
            if keys[at][2] == 0:
                nodes, labels, shared = nodes + node[at:upto], labels + label[at:upto], shared + crowds[at:upto]
                table = np.concatenate([table, part])
            else:
                centre = set(nodes)
                step = max(1, _CELLS // (MINIMA * max(1, len(nodes))))
                for i in range(0, len(part), step):
                    equal = (part[i : i + step, None, :] == table[None, :, :]).sum(axis=2)
                    x, y = np.nonzero(equal >= PLAUSIBLE * MINIMA)
                    found = []
                    for m, c in zip((x + at + i).tolist(), y.tolist()):
                        a, b = node[m], nodes[c]
                        if label[m] == labels[c] or (a > b and a in centre) or min(crowds[m] & shared[c]) != group[0]:
                            continue
                        found.append((a, b, label[m], labels[c]) if a < b else (b, a, labels[c], label[m]))
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], names=["a", "b", "la", "lb"])
            at = upto


def _groups(nodes: DataFrame) -> DataFrame:
    """(key, node, n): the bands that several nodes share, with their size."""
    keys = nodes.select("node", F.explode("keys").alias("key"))
    bands = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return keys.join(bands, "key")


def simhash_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b, la, lb): pairs of nodes that SimHash links; each node is its own label.  The nodes of one fingerprint
    meet its first node, and the first nodes of linked fingerprints meet."""
    first = nodes.groupBy("fp").agg(F.min("node").alias("a"))
    same = nodes.select("fp", F.col("node").alias("b")).join(first, "fp").where("a <> b").select("a", "b")
    near = simhash.links(first.select("fp"))
    ends = [first.select(F.col("fp").alias(f), F.col("a").alias(n)) for f, n in (("f", "x"), ("g", "y"))]
    met = near.select(F.col("a").alias("f"), F.col("b").alias("g")).distinct().join(ends[0], "f").join(ends[1], "g")
    pairs = same.unionByName(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    return pairs.withColumns({"la": F.col("a"), "lb": F.col("b")})


def still_apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) whose nodes are not in one group yet, labelled with their groups."""
    for x, label in (("a", "la"), ("b", "lb")):
        pairs = pairs.drop(label).join(roots.select(F.col("node").alias(x), F.col("root").alias(label)), x, "left")
    return pairs.select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb")).where("la <> lb")


def small_pairs(groups: DataFrame, nodes: DataFrame, crowd: int) -> DataFrame:
    """(a, b, la, lb): the pairs of the bands of ``crowd`` nodes or less that may be alike; each node is its own label."""
    few = groups.where(F.col("n") <= crowd).select("key", "node")
    met = (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node"))
    pairs = few.alias("x").join(few.alias("y"), met).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    left = nodes.select(F.col("node").alias("a"), F.col("signature").alias("s"))
    right = nodes.select(F.col("node").alias("b"), F.col("signature").alias("t"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "s", "t")
    return both.mapInArrow(_likely, "a binary, b binary").withColumns({"la": F.col("a"), "lb": F.col("b")})


def round_pairs(live: DataFrame, centres: int) -> tuple[DataFrame, DataFrame]:
    """(pairs of the nodes of each band with its heaviest nodes, the bands without these nodes)."""
    heavy = Window.partitionBy("key").orderBy(F.desc("weight"), "node")
    chosen = live.withColumn("rank", F.row_number().over(heavy)).where(F.col("rank") <= centres)
    salts = F.ceil(F.col("n") / _PART).cast("int")
    salt = F.pmod(F.xxhash64("node"), salts).cast("int")
    members = live.select("key", salt.alias("salt"), F.lit(1).alias("side"), "node", "label", "signature", "crowds")
    every = F.explode(F.sequence(F.lit(0), salts - 1))
    sent = chosen.select("key", every.alias("salt"), F.lit(0).alias("side"), "node", "label", "signature", "crowds")
    placed = members.unionByName(sent).repartition("key", "salt").sortWithinPartitions("key", "salt", "side")
    left = live.join(chosen.select("key", "node"), ["key", "node"], "left_anti")
    return placed.mapInArrow(_plausible, LINKS), left


def node_texts(docs: DataFrame, marked: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text): one text of each wanted node."""
    named = marked.groupBy("node").agg(F.min("text_hash").alias("h")).join(wanted, "node", "left_semi")
    text = text_or_empty()
    texts = docs.select(F.xxhash64(text).alias("th"), text.cast("binary").alias("text"))
    return texts.join(named, F.col("th") == F.col("h")).groupBy("node").agg(F.first("text").alias("text"))


def links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``pairs`` whose texts are alike."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("s"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("t"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "la", "lb", "s", "t")
    return both.mapInArrow(_verified, LINKS)


def joined_roots(roots: DataFrame, fresh: DataFrame) -> DataFrame:
    """(node, root) after the links ``fresh``: only the groups they touch are connected anew."""
    met = [fresh.select(F.col(x).alias("node"), F.col(label).alias("root")) for x, label in (("a", "la"), ("b", "lb"))]
    known = roots.unionByName(met[0]).unionByName(met[1]).distinct()
    moved = component_roots(fresh, "la", "lb").select(F.col("node").alias("root"), F.col("root").alias("to"))
    return known.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))


def linked_roots(docs: DataFrame, marked: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(node, root) of all linked nodes: every two nodes that agree in a band and are alike are
    linked, directly or through others."""
    spark = docs.sparkSession
    used: list[str] = []

    def kept(df: DataFrame, label: str) -> DataFrame:
        used.append(work_path(spark, label))
        return settle(df, used[-1])

    kinds = [F.first(c).alias(c) for c in ("keys", "signature", "fp")]
    nodes = kept(marked.groupBy("node").agg(*kinds), "alike-nodes")
    near = kept(simhash_pairs(nodes.select("node", "fp")), "alike-simhash")
    groups = kept(_groups(nodes), "alike-bands")
    few = kept(small_pairs(groups, nodes, crowd), "alike-pairs")
    many = groups.where(F.col("n") > crowd)
    weights = many.groupBy("node").agg(F.sum("n").alias("weight"), F.collect_list("key").alias("crowds"))
    wanted = near.unionByName(few).select(F.explode(F.array("a", "b")).alias("node")).unionByName(weights.select("node"))
    texts = kept(node_texts(docs, marked, wanted), "alike-texts")
    found = kept(links(near, texts), "alike-links")
    roots = kept(component_roots(found, "a", "b"), "alike-roots")
    more = kept(links(still_apart(few, roots), texts), "alike-links")
    at = work_path(spark, "alike-roots")
    roots = settle(joined_roots(roots, more), at)
    drawn = nodes.select("node", "signature").join(weights, "node")
    bands = kept(many.drop("n").join(drawn, "node"), "alike-crowds")
    crowded = kept(texts.join(weights, "node", "left_semi"), "alike-crowd-texts")
    centres = CENTRES
    while not bands.isEmpty():
        labelled = bands.join(roots.withColumnRenamed("root", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
        apart = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n"))
        live = kept(labelled.join(apart.where("lo <> hi").select("key", "n"), "key"), "alike-live")
        pairs, left = round_pairs(live, centres)
        pairs = kept(pairs, "alike-pairs")
        if not pairs.isEmpty() and not (fresh := kept(links(pairs, crowded), "alike-links")).isEmpty():
            used.append(at)
            at = work_path(spark, "alike-roots")
            roots = settle(joined_roots(roots, fresh), at)
        bands = kept(left.drop("label", "n"), "alike-crowds")
        centres = min(MOST, centres * MORE)
    for path in used:
        discard(spark, path)
    return roots


def near_duplicates(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, ``root`` (a node that names the group)."""
    text = text_or_empty()
    texts = docs.select(F.col("doc_id").cast("long"), text.cast("binary").alias("text"), F.xxhash64(text).alias("h"))
    marked = settle(texts.mapInArrow(_marked, MARKED), work_path(docs.sparkSession, "alike"))
    roots = linked_roots(docs, marked, crowd).select(F.col("node").alias("n"), "root")
    found = marked.join(roots, F.col("node") == F.col("n"), "left")
    return found.select("doc_id", "text_hash", F.coalesce("root", "node").alias("root"))
