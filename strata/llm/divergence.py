"""Source divergence audit: how far the word use of the sources of a language lies apart.

Every (lang, source) group and every language gives each kept term of the language a smoothed share
``p`` in parts of 10^9.  Two groups differ by the sum of ``f = (p - q)^2 / (p + q)`` over all kept terms,
most of which neither of them has.

Gustavson row accumulation: postings stand term by term (the index).  A group, as a row, goes through its
own terms, and each term's postings are scattered into an accumulator with one place per peer.  No pair of postings is ever
a row: a block of terms gives one sum per group and peer.  What is scattered is the difference to the zero
baseline, which each group adds for its peers at once: a term that a peer lacks has that peer's smallest share ``z``, so

    value(g, h) = sum over terms of g of f(p, z_h) + sum over terms of h of f(z_g, q)
                  + (V - n_g - n_h) f(z_g, z_h)
                  + sum over common terms of f(p, q) - f(p, z_h) - f(z_g, q) + f(z_g, z_h)

where the first two sums run over the different counts of a group, not its terms.

Shuffled are counts per group and term, already summed per task, and the kept postings.  All arithmetic
is on integers; products that may pass 64 bits are decimals.

Defined results: NULL text, lang and source are ''; every row is a document, repeated rows too; a group
without kept terms has the baseline alone; a language without kept terms has pairs of value 0 and no terms;
ties are ranked by item; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import settle, work_path

MIN_DOCS, TOP_TERMS, UNIT, SMOOTH = 10, 10, 1_000_000_000, 2
BROADCAST_ROWS = 200_000  # groups that are sent to every task; more are joined by a shuffle
ENTRIES = 300_000  # counts a task holds before it passes them on
BLOCK = 500_000  # postings of a block of terms
# The letters of a term, all bytes but the ASCII ones that are no letters; A-Z is lower-cased.
LETTERS = bytes(b | 0x20 if 65 <= b <= 90 else b if b >= 0x80 or 97 <= b <= 122 else 0x20 for b in range(256))
COUNTED = "lang string, source string, term binary, n long, docs long"
SCATTERED = "lang string, source string, item string, value long"


def terms(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            if n:
                words = list(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(words), pa.string()),
                        pa.array([source] * len(words), pa.string()),
                        pa.array(words, pa.binary()),
                        pa.array([n[w] for w in words], pa.int64()),
                        pa.array([docs[w] for w in words], pa.int64()),
                    ],
                    names=[f.split()[0] for f in COUNTED.split(", ")],
                )
        held.clear()

    size = 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            found = terms(text.as_py())
            before = len(n)
            n.update(found)
            docs.update(set(found))
            size += len(n) - before
            if size >= ENTRIES:
                yield from passed_on()
                size = 0
    yield from passed_on()


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def term_index(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per kept term of a language: its count there and its postings (source, n), one per source at most."""
    texts = docs.select(_filled("lang"), _filled("source"), _filled("text").cast("binary").alias("text"))
    counts = (
        texts.mapInArrow(_counted, COUNTED)
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    return (
        counts.groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum("n").alias("lang_n"),
            F.collect_list(F.struct("source", "n")).alias("postings"),
        )
        .where(F.col("docs") >= min_docs)
        .select("lang", F.col("term").cast("string").alias("term"), "lang_n", "postings")
    )


def share(n: Column, total: Column, v: Column) -> Column:
    """p = 1 + floor(UNIT (n + 2) / (total + 2 v)); 1 where the language keeps nothing."""
    wide = "decimal(28,0)"
    over = (F.lit(UNIT).cast("decimal(10,0)") * (n + SMOOTH).cast(wide)).cast("decimal(38,0)")
    under = (total + SMOOTH * v).cast(wide)
    return F.when(v > 0, 1 + F.call_function("div", over, under)).otherwise(F.lit(1)).cast("long")


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def group_table(docs: DataFrame, postings: DataFrame, languages: DataFrame) -> DataFrame:
    """One row per (lang, source): kept occurrences ``total``, kept terms ``n_terms``, ``v`` and ``lang_total`` of
    the language, share ``z`` of a term it lacks."""
    own = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_terms"))
    every = docs.select(_filled("lang"), _filled("source")).distinct()
    zero = F.lit(0).cast("long")
    return (
        every.join(own, ["lang", "source"], "left")
        .join(languages, "lang", "left")
        .select(
            "lang",
            "source",
            F.coalesce("total", zero).alias("total"),
            F.coalesce("n_terms", zero).alias("n_terms"),
            F.coalesce("v", zero).alias("v"),
            F.coalesce("lang_total", zero).alias("lang_total"),
        )
        .withColumn("z", share(zero, F.col("total"), F.col("v")))
    )


def scatter(term: np.ndarray, group: np.ndarray, p: np.ndarray, z: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For one block of terms and each group in it: (group, peers, differences to the baseline).

    ``term``, ``group``, ``p`` are one posting each, the terms in order; ``z`` is by group.
    """
    begins = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
    sizes = np.diff(np.r_[begins, len(term)])
    place = np.repeat(np.arange(len(begins)), sizes)  # of a posting's term
    by_group = np.argsort(group, kind="stable")
    cuts = np.searchsorted(group[by_group], np.arange(len(z) + 1))
    total = np.zeros(len(z), dtype=np.int64)
    for g in range(len(z)):
        own = by_group[cuts[g] : cuts[g + 1]]
        if not len(own):
            continue
        many = sizes[place[own]]
        upto = np.cumsum(many)
        at = np.arange(upto[-1]) + np.repeat(begins[place[own]] - (upto - many), many)
        mine, peer, theirs = np.repeat(p[own], many), group[at], p[at]
        more = gaps(mine, theirs) - gaps(mine, z[peer]) - gaps(z[g], theirs) + gaps(z[g], z[peer])
        total[:] = 0
        np.add.at(total, peer, more)
        met = np.unique(peer)
        met = met[met != g]
        yield g, met, total[met]


def _scattered(block: int):
    def of_language(lang: str, table: pa.Table) -> Iterator[pa.RecordBatch]:
        names, first, group = np.unique(
            table["source"].to_numpy(zero_copy_only=False).astype(object), return_index=True, return_inverse=True
        )
        term = table["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        z = table["z"].to_numpy()[first]
        source = pa.array(names, pa.string())
        for g, met, value in scatter(term, group, table["p"].to_numpy(), z):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(met), pa.string()),
                    pa.array([names[g]] * len(met), pa.string()),
                    source.take(pa.array(met)),
                    pa.array(value, pa.int64()),
                ],
                names=[f.split()[0] for f in SCATTERED.split(", ")],
            )

    def of_block(table: pa.Table) -> Iterator[pa.RecordBatch]:
        langs = table["lang"].combine_chunks().dictionary_encode()
        codes = langs.indices.to_numpy()
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            at = np.flatnonzero(codes == i)  # sorted by language, so they stand together
            yield from of_language(lang, table.slice(int(at[0]), len(at)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) >= block:
                table = pa.Table.from_batches(held)
                # The last term may go on in the next batch.
                last = table.slice(table.num_rows - 1)
                still = pc.and_(pc.equal(table["term"], last["term"][0]), pc.equal(table["lang"], last["lang"][0]))
                n = table.num_rows - pc.sum(still).as_py()
                if n:
                    yield from of_block(table.slice(0, n))
                    held = table.slice(n).to_batches()
        if held:
            yield from of_block(pa.Table.from_batches(held))

    return run


def _baselines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each group adds to the pairs (itself, peer) and (peer, itself)."""
    for batch in batches:
        for row in batch.to_pylist():
            z, n, v = row["z"], row["n_terms"], row["v"]
            peers = [x for x in row["peers"] if x["source"] != row["source"]]
            if not peers:
                continue
            zs = np.array([x["z"] for x in peers], dtype=np.int64)
            total = np.zeros(len(peers), dtype=np.int64)
            for count in row["counts"] or ():
                total += count["many"] * gaps(np.int64(count["p"]), zs)
            none = gaps(np.int64(z), zs)
            names = pa.array([x["source"] for x in peers], pa.string())
            own = pa.array([row["source"]] * len(peers), pa.string())
            lang = pa.array([row["lang"]] * len(peers), pa.string())
            head = [f.split()[0] for f in SCATTERED.split(", ")]
            yield pa.RecordBatch.from_arrays([lang, own, names, pa.array(total + (v - n) * none)], names=head)
            yield pa.RecordBatch.from_arrays([lang, names, own, pa.array(total - n * none)], names=head)


def pair_values(priced: DataFrame, groups: DataFrame, block: int = BLOCK) -> DataFrame:
    """(lang, source, item, value) of every two groups of a language.

    Blocks are cut from terms dealt by hash; a group's rows are one per different count, its peers one per source.
    """
    placed = priced.select("lang", "term", "source", "p", "z").repartition("lang", "term").sortWithinPartitions("lang", "term")
    scattered = placed.mapInArrow(_scattered(block), SCATTERED)
    many = priced.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("many"))
    counts = many.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "many")).alias("counts"))
    peers = groups.groupBy("lang").agg(F.collect_list(F.struct("source", "z")).alias("peers"))
    rows = groups.join(counts, ["lang", "source"], "left").join(peers, "lang")
    base = rows.select("lang", "source", "z", "n_terms", "v", "counts", "peers").mapInArrow(_baselines, SCATTERED)
    return scattered.unionByName(base).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).cast("int").alias("rank")
    )


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """Both parts: ``pair``, every other source of the language by its distance, and ``term``, the terms
    that a group uses more than its language, the ``top`` of them."""
    spark = docs.sparkSession
    index = settle(term_index(docs, min_docs), work_path(spark, "term-index"))
    postings = index.select("lang", "term", "lang_n", F.inline("postings"))
    languages = index.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = settle(group_table(docs, postings, languages), work_path(spark, "term-groups"))
    # A hot source would meet in one task of a shuffle, so postings stay where they are while groups are few.
    near = F.broadcast(groups) if groups.count() <= BROADCAST_ROWS else groups
    priced = (
        postings.join(near, ["lang", "source"])
        .withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))
        .withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("v")))
    )
    over = priced.where("p > q").select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    return _ranked(pair_values(priced, groups), "pair").unionByName(_ranked(over, "term").where(F.col("rank") <= top))
