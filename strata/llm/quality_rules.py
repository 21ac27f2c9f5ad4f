"""Quality rules: rules on one text, and lines that too many documents of a host share.

Native: DataFrame functions only.  The lines of a document are normalised and
hashed, the documents of a host (``source``) that hold a line are counted, lines
above the limits are removed, and a document that keeps too little is rejected.

Copies must not make each other look like page furniture: the documents that hold a
line and the documents of the host are both counted by their whole text, so a group of
exact copies counts once on either side.  Edited copies are documents of their own.

Defined results: a NULL text is an empty text; a document without lines keeps
nothing and fails on its word count; a NULL host is a host of its own; rows that
repeat a document get the same result each and count once; an empty table gives
an empty result; other columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import NOT_SPACE, SPACE, let, packed, text_or_empty, unpacked, words
from strata.session import settle, work_path

KEY = ("doc_id", "text_hash")


@dataclass(frozen=True)
class Rules:
    """``min_docs`` and ``min_share`` (of the host's different texts) are the limits a line
    must both reach to be removed; a document that then has less than ``min_left`` of
    its words is depleted."""

    min_words: int = 50
    max_repeat_percent: int = 50
    min_docs: int = 10
    min_share: float = 0.02
    min_left: float = 0.3
    salts: int = 32


def _covered(hashes: Column, width: int) -> Column:
    """Words inside windows that occur twice or more; ``hashes``: of all windows."""

    def places(ordered: Column) -> Column:
        def again(i: Column) -> Column:
            h = F.get(ordered, i)["h"]
            before = F.coalesce(h == F.get(ordered, i - 1)["h"], F.lit(False))
            return before | F.coalesce(h == F.get(ordered, i + 1)["h"], F.lit(False))

        found = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), again)
        return F.array_sort(F.transform(found, lambda i: F.get(ordered, i)["i"]))

    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    total = F.aggregate(
        let(ordered, places),
        start,
        lambda acc, at: F.struct(
            (at + width).alias("end"), (acc["n"] + at + width - F.greatest(at, acc["end"])).cast("long").alias("n")
        ),
        lambda acc: acc["n"],
    )
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(total)


def repeated_words(w: Column, width: int = 3) -> Column:
    """Words of ``w`` in windows of ``width`` words found twice or more, the first included."""

    def of(w: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(w) - width),
            lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(width))),
        )
        return F.when(F.size(w) > width, let(hashes, lambda h: _covered(h, width))).otherwise(F.lit(0).cast("long"))

    return let(w, of)


def text_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Every row of ``docs`` in ``row``, its key, and the rules on its text: word and
    symbol counts, repeats, ``base_failed``."""
    text = F.col("t")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE))
    counted = packed(docs, F.col("doc_id"), text_or_empty().alias("t")).select(
        "row",
        "doc_id",
        F.xxhash64("t").alias("text_hash"),
        let(
            words(text),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                repeated_words(w).alias("n_repeat_words"),
            ),
        ).alias("w"),
        (F.char_length(text) - F.char_length(F.regexp_replace(text, r"[#*$%&|<>]+", "")))
        .cast("long")
        .alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    return counted.select("row", *KEY, "w.*", "n_symbols", "n_dup_lines").withColumn("base_failed", failed)


def normalised_line(line: Column) -> Column:
    """Lower case, single blanks, none at the ends, digits as 0."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(line), f"{SPACE}+", " ")), "[0-9]", "0")


def line_table(docs: DataFrame) -> DataFrame:
    """One row per line with a word: key, host, ``pos``, hash, words."""
    found = F.transform(
        F.split("t", "\n"),
        lambda x, i: F.struct(i.alias("pos"), normalised_line(x).alias("line"), F.size(words(x)).alias("n")),
    )
    return (
        docs.select("doc_id", "source", text_or_empty().alias("t"))
        .select(
            "doc_id",
            F.xxhash64("t").alias("text_hash"),
            "source",
            F.transform(F.filter(found, lambda x: x["n"] > 0), _line_row).alias("rows"),
        )
        .select(*KEY, "source", F.inline("rows"))
    )


def _line_row(x: Column) -> Column:
    return F.struct(
        x["pos"].alias("pos"),
        F.xxhash64(x["line"]).alias("line_hash"),
        x["n"].cast("long").alias("n"),
    )


def frequent_lines(lines: DataFrame, docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(source, line_hash) above both limits, by the documents of the host that differ.

    The documents of a line are dealt by line and text, so a line that a third of all
    documents hold is spread, and is counted from one row per task.
    """
    texts = docs.select(F.col("source").alias("host"), F.xxhash64(text_or_empty()).alias("h"))
    hosts = texts.groupBy("host", "h").agg(F.lit(1)).groupBy("host").agg(F.count(F.lit(1)).alias("n_host"))
    held = (
        lines.groupBy("source", "line_hash", "text_hash")
        .agg(F.lit(1))
        .groupBy("source", "line_hash")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .where(F.col("n_docs") >= rules.min_docs)
    )
    return held.join(hosts, F.col("source").eqNullSafe(F.col("host"))).where(
        F.col("n_docs") >= F.lit(rules.min_share) * F.col("n_host")
    ).select("source", "line_hash", "n_docs")


def removed_lines(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Per document that loses lines: key, their positions (sorted), their words.

    The lines are settled, as they are read twice.  Lines above the limits are hot
    keys by nature: the join is salted by document, and the frequent side, at most
    (lines per document / min_share) rows a host, is repeated per salt.
    """
    spark = docs.sparkSession
    lines = settle(line_table(docs), work_path(spark, "lines"))
    salt = F.pmod(F.xxhash64(*KEY), F.lit(rules.salts)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(rules.salts - 1)))
    frequent = frequent_lines(lines, docs, rules).select(
        F.col("source").alias("f_source"), F.col("line_hash").alias("f_hash"), every.alias("f_salt")
    )
    hit = lines.withColumn("salt", salt).join(
        frequent,
        F.col("source").eqNullSafe(F.col("f_source"))
        & (F.col("line_hash") == F.col("f_hash"))
        & (F.col("salt") == F.col("f_salt")),
        "left_semi",
    )
    return hit.groupBy(*KEY).agg(F.sort_array(F.collect_set(F.struct("pos", "n"))).alias("gone")).select(
        F.col("doc_id").alias("r_doc_id"),
        F.col("text_hash").alias("r_text_hash"),
        F.transform("gone", lambda x: x["pos"]).alias("positions"),
        F.aggregate("gone", F.lit(0).cast("long"), lambda acc, x: acc + x["n"]).alias("words_removed"),
    )


def _same_document() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("r_doc_id")) & (F.col("text_hash") == F.col("r_text_hash"))


def _ruled(docs: DataFrame, rules: Rules) -> DataFrame:
    joined = text_rules(docs, rules).join(removed_lines(docs, rules), _same_document(), "left")
    gone = F.coalesce("words_removed", F.lit(0).cast("long"))
    depleted = (gone > 0) & (F.col("n_words") - gone < F.lit(rules.min_left) * F.col("n_words"))
    return joined.select(
        "row",
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        gone.alias("words_removed"),
        F.coalesce("positions", F.array().cast("array<int>")).alias("positions"),
        "base_failed",
        depleted.alias("depleted"),
        (~F.col("base_failed") & ~depleted).alias("kept"),
    )


def verdicts(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``docs``: the counts, words and lines removed, ``base_failed``,
    ``depleted``, ``kept``."""
    return (
        _ruled(docs, rules)
        .withColumn("lines_removed", F.size("positions").cast("long"))
        .drop("row", "positions")
    )


def kept_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, without their frequent lines; ``n_chars`` follows the
    text.  The columns are those of ``docs``."""
    text = F.col("row")["text"]
    left = let(
        F.split(text, "\n"),
        lambda lines: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("positions")),
                lambda i: F.get(lines, i),
            ),
            "\n",
        ),
    )
    new = F.when(F.size("positions") > 0, left).otherwise(text)
    passed = _ruled(docs, rules).where("kept").withColumn("new", new)
    return unpacked(passed, docs, text=F.col("new"), n_chars=F.char_length("new"))
