"""Raw snapshot scans: choose a snapshot, read one row per source object.

Every scan returns ``element`` (JSON text of one object), ``src_file`` and the
arrival ordinal ``_ord``, a struct that sorts rows as they stand in the files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import payload as P
from strata.session import file_system
from strata.sources.array_split import split_elements

ORDINAL = "struct<src_file:string,block:bigint,pos:bigint,part:int>"


SUFFIX = {"array": "json", "indented": "json", "lines": "jsonl"}


def latest_snapshot_path(spark: SparkSession, folder: str, source: str, suffix: str = "json") -> str:
    """Newest ``<source>_<date>.<suffix>``, a file or a folder of part files.

    Dates are zero padded, so the greatest name is the newest.  Only the folder is
    listed, one entry per day.  A folder without the marker of a finished write is
    passed over.
    """
    pattern, files = file_system(spark, f"{folder}/{source}_*.{suffix}")
    found = [
        status.getPath().toString()
        for status in files.globStatus(pattern) or []
        if not status.isDirectory() or files.exists(marker(spark, status.getPath().toString()))
    ]
    if not found:
        raise FileNotFoundError(f"no finished {source} snapshot in {folder}")
    return max(found)


def marker(spark: SparkSession, path: str):
    """The file that a writer leaves in a folder it has finished."""
    return file_system(spark, f"{path}/_SUCCESS")[0]


def dated_snapshot_path(folder: str, source: str, day: dt.date, suffix: str = "json") -> str:
    return f"{folder}/{source}_{day:%Y_%m_%d}.{suffix}"


def latest_rows(df: DataFrame, day: str) -> DataFrame:
    """Rows of the newest value of a snapshot date column.

    The newest value is a scalar subquery, so it prunes partitions or row groups
    of the outer scan and nothing is joined.
    """
    return df.where(F.col(day) == df.select(F.max(day)).scalar())


def latest_day_rows(df: DataFrame, ts: str) -> DataFrame:
    """Rows of the newest day of a timestamp column; the bound reaches the scan."""
    first = df.select(F.date_trunc("day", F.max(ts)).cast(df.schema[ts].dataType)).scalar()
    return df.where(F.col(ts) >= first)


def dated_rows(df: DataFrame, ts: str, day: dt.date) -> DataFrame:
    """Rows of one day, as a range the scan can push down."""
    dtype = df.schema[ts].dataType
    start, end = F.lit(day).cast(dtype), F.lit(day + dt.timedelta(days=1)).cast(dtype)
    return df.where((F.col(ts) >= start) & (F.col(ts) < end))


def array_elements(body: Column) -> Column:
    """Element texts of a snapshot body: those of an array, one single value, or
    none at all when the text is not JSON as a whole."""
    root = P.whole_json(body)
    single = F.when(root.isNotNull(), F.array(F.to_json(root)))
    return F.coalesce(P.element_texts(root), single)


def is_json(body: Column) -> Column:
    return P.whole_json(body).isNotNull()


def unwrap_arrays(bodies: DataFrame, body: str = "value") -> DataFrame:
    """One row per array element, with its position ``pos``; the other columns stay."""
    others = [c for c in bodies.columns if c != body]
    return bodies.select(*others, F.posexplode(array_elements(F.col(body))).alias("pos", "element"))


def _with_ordinal(rows: DataFrame) -> DataFrame:
    part = F.col("part") if "part" in rows.columns else F.lit(0)
    return rows.select(
        "element",
        "src_file",
        F.struct(file_order("src_file").alias("src_file"), "block", "pos", part).cast(ORDINAL).alias("_ord"),
    )


def file_order(path: str) -> Column:
    """A path that sorts part files by their number, also past five digits."""
    number = F.regexp_extract(path, r"/part-(\d+)[^/]*\z", 1)
    padded = F.concat(F.regexp_replace(path, r"/part-\d+([^/]*)\z", "/part-"), F.lpad(number, 12, "0"), F.col(path))
    return F.when(number != "", padded).otherwise(F.col(path))


def _bodies(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("src_file"), F.lit(0).alias("block")
    )


def read_array_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files that each hold one JSON array, or one object.  An invalid file gives
    no rows (see ``invalid_array_files``).  One task reads one file."""
    return _with_ordinal(unwrap_arrays(_bodies(spark, path)))


def invalid_array_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Paths of the files ``read_array_files`` has to pass over."""
    return _bodies(spark, path).where(~is_json(F.col("value"))).select("src_file")


def _lines(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    return spark.read.text(path, **options).select(
        "value",
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )


def read_json_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One object per line.  Files split across tasks; the ordinal is the file,
    the block offset, and the running row id inside the block."""
    rows = _lines(spark, path).where(F.trim("value") != "")
    return _with_ordinal(rows.withColumnRenamed("value", "element"))


def read_indented_arrays(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Array files pretty-printed with an indent of four, read in parallel.

    A line break never stands inside a JSON string, so a closing brace after a
    line break and four blanks always ends an element.  Splitting there cuts one
    large file over many tasks and keeps the element text as it was received.
    Elements written on one line (scalars, {}) stay in front of the next object
    and are taken apart as an array.  A file without the bracket that ends its array
    was cut off, or is no array, and gives no rows.
    """
    rows = _lines(spark, path, lineSep="\n    },\n")
    text = F.col("value")
    closed = rows.where(text.rlike(r"\n\]\s*\z") | text.rlike(r"\A\[\s*\]\s*\z")).select("src_file").distinct()
    rows = rows.join(F.broadcast(closed), "src_file", "left_semi")  # one row per file
    last = text.rlike(r"\n\]\s*\z") | text.rlike(r"\A\[\s*\]\s*\z")
    body = F.regexp_replace(text, r"\A\[\s*|\A\s+|\n\]\s*\z", "")
    # The separator took the closing brace of every element but the last of a file.
    rows = rows.select(
        "src_file",
        "block",
        "pos",
        F.when(text.rlike(r"\A\[\s*\]\s*\z"), F.lit(""))
        .when(last, body)
        .otherwise(F.concat(body, F.lit("\n    }")))
        .alias("_text"),
    ).where(F.col("_text") != "")
    several = F.col("_text").rlike(r"\A[^{]|\A\{\}|\n    [^ }]")
    listed = P.element_texts(P.whole_json(F.concat(F.lit("["), "_text", F.lit("]"))))
    parts = F.when(several, F.coalesce(listed, F.array("_text"))).otherwise(F.array("_text"))
    return _with_ordinal(
        rows.select("src_file", "block", "pos", F.posexplode(parts).alias("part", "element"))
    )


def read_split_arrays(spark: SparkSession, path: str | list[str], scratch: str | None = None) -> DataFrame:
    """``read_array_files`` with every file read by many tasks, also one that is a single line."""
    return _with_ordinal(split_elements(spark, path, scratch))


def read_arrays(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Array files of any size: whole where no file is larger than a task should read, else split.
    The rows are the same; a compressed file cannot be split."""
    limit = int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b"))
    sizes = []
    for p in [path] if isinstance(path, str) else path:
        pattern, files = file_system(spark, p)
        for status in files.globStatus(pattern) or []:
            inside = files.listStatus(status.getPath()) if status.isDirectory() else [status]
            sizes += [s.getLen() for s in inside if s.isFile() and s.getPath().getName().endswith((".json", ".txt"))]
    return read_split_arrays(spark, path) if max(sizes, default=0) > limit else read_array_files(spark, path)


READERS = {
    "array": read_arrays,
    "lines": read_json_lines,
    "indented": read_indented_arrays,
}
