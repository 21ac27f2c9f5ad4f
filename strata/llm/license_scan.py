"""License scans by diagonal voting.

Native: DataFrame functions only.  Every run of k words of a document is hashed and
joined to the places of the same run in the templates.  A match votes for its diagonal,
the offset between the two places; the votes of neighbouring diagonals are merged (a word more or less
shifts what follows by one), and a span counts if its runs cover enough of the template.
Every match is verified by its words before it votes, so hashes only find.

Short phrases are templates that must be covered whole.  The table of template runs holds one row per word of
the templates given, whatever the data, and is broadcast; documents are never
shuffled, only their matches are.

Defined results: a NULL text is empty; rows that repeat a document get the same result
each; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import let, text_or_empty

# What the contract takes for the gaps between words, once A-Z is lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"


@dataclass(frozen=True)
class Template:
    """``label`` of a text; ``whole``: a phrase that must stand there word for word."""

    label: str
    text: str
    whole: bool = False


# Phrases of the contract.
PHRASES = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)
# The usual notices of public licenses.
NOTICES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    Template("mit", "Released under the MIT License"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    Template("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
)


@dataclass(frozen=True)
class Voting:
    """Run lengths of phrases and of notices, diagonals merged up to ``drift`` apart, the
    ``cover`` of a template's runs a span needs."""

    phrase_k: int = 2
    notice_k: int = 3
    drift: int = 2
    cover: float = 0.6


def lower_words(text: Column) -> Column:
    """Words once A-Z is lower-cased.  ``lower`` changes other letters too, but no letter
    outside A-Z becomes one of a-z, save the Kelvin sign, which is replaced before."""
    return F.array_remove(F.split(F.lower(F.replace(text, F.lit("K"), F.lit("å"))), f"{GAP}+"), "")


def runs(words: Column, k: int) -> Column:
    """(pos, k, hash, words) of every run of k words.  A run brings its own words, so that no row
    carries the whole text."""
    last = F.size(words) - k
    found = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(
            i.alias("pos"),
            F.lit(k).alias("k"),
            F.xxhash64(*(F.get(words, i + j) for j in range(k))).alias("hash"),
            F.array(*(F.get(words, i + j) for j in range(k))).alias("words"),
        ),
    )
    return F.when(last >= 0, found).otherwise(F.array().cast("array<struct<pos:int,k:int,hash:bigint,words:array<string>>>"))


def template_runs(spark: SparkSession, templates: tuple[Template, ...], how: Voting) -> DataFrame:
    """One row per run of a template: number, label, k, place, hash, words, runs in all."""
    rows = [(i, t.label, t.text, t.whole, how.phrase_k if t.whole else how.notice_k) for i, t in enumerate(templates)]
    table = spark.createDataFrame(rows, "template int, label string, text string, whole boolean, t_k int")
    words = table.withColumn("w", lower_words(F.col("text")))
    each = [
        words.where(F.col("t_k") == k).select(
            "template", "label", "whole", "t_k", (F.size("w") - k + 1).alias("n_runs"), F.inline(runs(F.col("w"), k))
        )
        for k in sorted({how.phrase_k, how.notice_k})
    ]
    every = each[0] if len(each) == 1 else each[0].unionByName(each[1])
    return every.select(
        "template",
        "label",
        "whole",
        "n_runs",
        "t_k",
        F.col("hash").alias("t_hash"),
        F.col("pos").alias("t_pos"),
        F.col("words").alias("t_words"),
    )


def matches(docs: DataFrame, templates: tuple[Template, ...], how: Voting) -> DataFrame:
    """Verified matches: document, template, places in both."""
    ks = sorted({how.phrase_k, how.notice_k})
    hashed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_or_empty()).alias("text_hash"),
        lower_words(text_or_empty()).alias("w"),
    ).select("doc_id", "text_hash", F.inline(let(F.col("w"), lambda w: F.concat(*(runs(w, k) for k in ks)))))
    table = F.broadcast(template_runs(docs.sparkSession, templates, how))
    met = hashed.join(table, (F.col("hash") == F.col("t_hash")) & (F.col("k") == F.col("t_k")))
    return met.where(F.col("words") == F.col("t_words")).select(
        "doc_id", "text_hash", "template", "label", "whole", "n_runs", "k", "pos", "t_pos"
    )


def spans(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES, how: Voting = Voting()) -> DataFrame:
    """Verified spans: document, label, ``whole``, first and last word, ``coverage``.

    Votes are distinct places of a template per diagonal, at most its length, so the
    partial aggregates stay small however often a phrase is repeated, and repeated rows do
    not vote twice.  A window orders the diagonals of one document and template.
    """
    key = ["doc_id", "text_hash", "template", "label", "whole", "n_runs", "k"]
    votes = (
        matches(docs, templates, how)
        .withColumn("diagonal", F.col("pos") - F.col("t_pos"))
        .groupBy(*key, "diagonal")
        .agg(F.collect_set("t_pos").alias("places"))
    )
    order = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order)
    fresh = F.col("whole") | apart.isNull() | (apart > how.drift)
    merged = (
        votes.withColumn("fresh", fresh.cast("int"))
        .withColumn("span", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*key, "span")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n_places"),
            F.min(F.col("diagonal") + F.array_min("places")).alias("first"),
            F.max(F.col("diagonal") + F.array_max("places") + F.col("k") - 1).alias("last"),
        )
    )
    coverage = F.col("n_places") / F.col("n_runs")
    return merged.withColumn("coverage", coverage).where(
        F.when(F.col("whole"), F.col("n_places") == F.col("n_runs")).otherwise(F.col("coverage") >= how.cover)
    )


def _labels(c: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(c)), ",")


def scan(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES, how: Voting = Voting()) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``n_words``, places and labels of the phrases,
    labels of all templates, and the best coverage as ``score``."""
    phrase = F.col("whole")
    found = (
        spans(docs, templates, how)
        .groupBy("doc_id", "text_hash")
        .agg(
            F.count_if(phrase).alias("n_base"),
            F.min(F.when(phrase, F.col("first"))).cast("long").alias("first_word"),
            F.max(F.when(phrase, F.col("first"))).cast("long").alias("last_word"),
            _labels(F.when(phrase, F.col("label"))).alias("base_labels"),
            _labels(F.col("label")).alias("labels"),
            F.max("coverage").alias("score"),
        )
        .withColumnsRenamed({"doc_id": "f_id", "text_hash": "f_hash"})
    )
    every = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_or_empty()).alias("text_hash"),
        F.size(lower_words(text_or_empty())).cast("long").alias("n_words"),
    )
    joined = every.join(
        found, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("text_hash") == F.col("f_hash")), "left"
    )
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
