"""Column helpers and the lookup of this package by Python workers."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space the text contracts name (blank, tab to carriage return).
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def shipped(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, whatever folder the session began in.

    A cluster that installs the package, or gets it with --py-files, needs nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])
    return spark


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body, or a
    lambda inside it, refers to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def words(text: Column, gap: str = SPACE) -> Column:
    """Words of a text: what stands between runs of ``gap``."""
    return F.array_remove(F.split(text, f"{gap}+"), "")


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """Each row whole in one struct ``row`` beside computed columns, so that no
    column of the input can clash with one of ours."""
    return docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), *more)


def unpacked(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` again, some of them replaced."""
    return rows.select(
        *(changed.get(c, F.col("row").getField(c)).cast(docs.schema[c].dataType).alias(c) for c in docs.columns)
    )
