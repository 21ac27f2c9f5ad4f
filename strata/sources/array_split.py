"""Any JSON array file read by many tasks, also one that is a single line.

The file is cut at closing braces wherever a task's byte range begins, without knowing what the brace means
there.  A first pass over each range finds what it does to a reader that enters it outside a string, and
to one that enters it inside: where such a reader would leave it, and how deep.  These maps are composed in
file order, one row per range, which gives the state at the start of every range.  A second pass cuts
the elements exactly; one that crosses ranges comes out as a piece of each and is put together again.

An escape never crosses a cut: no escape of JSON ends in a brace, and a file that has one is invalid.  A file that
is not one JSON value as a whole gives no rows.  A file that holds one value and no array is one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions import payload as P
from strata.session import settle, work_path

CUT = b"}"
BROADCAST_RANGES = 200_000  # byte ranges whose states are sent to every task; more are joined by a shuffle
# Characters between the tokens of a JSON text, and those that shape it.
BLANK = b" \t\n\r"
SHAPE = np.zeros(256, dtype=np.int8)
SHAPE[list(b"{[")], SHAPE[list(b"}]")], SHAPE[list(b",")] = 1, -1, 2  # deeper, shallower, neither
ESCAPED = re.compile(rb"\\.", re.DOTALL)

PROFILE = "rid long, src_file string, block long, file_size long, size long, root string, flips int, deep_out long, deep_in long"
PIECES = "rid long, pos long, head string, tail string, text string"


def shape(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(places, kinds, quotes before each, quotes) of the braces, brackets and commas."""
    plain = np.frombuffer(ESCAPED.sub(b"  ", data) if b"\\" in data else data, dtype=np.uint8)
    kinds = SHAPE[plain]
    at = np.flatnonzero(kinds)
    quotes = np.flatnonzero(plain == 34)
    return at, kinds[at], np.searchsorted(quotes, at), len(quotes)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[bytes]]]:
    """(a range's columns, its next texts), in file order.  Columns are the same in all rows of a range."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rids = batch.column(0).to_numpy()
        cuts = np.r_[0, np.flatnonzero(rids[1:] != rids[:-1]) + 1, len(rids)].tolist()
        for a, b in zip(cuts, cuts[1:]):
            columns = {name: batch.column(i)[a].as_py() for i, name in enumerate(batch.schema.names) if i != 1}
            yield columns, batch.column(1)[a:b].to_pylist()


def _batch(rows: list[tuple], shape_: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [f.split() for f in shape_.split(", ")]
    arrays = [pa.array(column, kinds[kind]) for column, (_, kind) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


class Profile:
    """What a byte range does to a reader, whichever way it enters."""

    def __init__(self, of: dict):
        self.of, self.size, self.flips, self.deep, self.root = of, 0, 0, [0, 0], None

    def add(self, texts: list[bytes]) -> None:
        data = CUT.join(texts) + CUT
        self.size += len(data)
        if not self.root:
            self.root = data.lstrip(BLANK)[:1].decode("latin-1") or None
        _, kinds, before, quotes = shape(data)
        moves = np.where(kinds == 2, 0, kinds)
        for inside in (0, 1):  # braces count where the reader is outside of strings
            self.deep[inside] += int(moves[(before + self.flips + inside) % 2 == 0].sum(dtype=np.int64))
        self.flips = (self.flips + quotes) % 2

    def row(self) -> tuple:
        return *self.of.values(), self.size, self.root, self.flips, *self.deep


def _profiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for of, texts in _ranges(batches):
        if now is None or now.of["rid"] != of["rid"]:
            if now is not None:
                yield _batch([now.row()], PROFILE)
            now = Profile(of)
        now.add(texts)
    if now is not None:
        yield _batch([now.row()], PROFILE)


class Cutter:
    """Cuts the elements of one byte range; ``of`` says what the ranges before it lead to.

    ``head`` and ``tail`` of a piece are what stands before and after it: a bracket, a brace, a comma, the
    begin (^) or the end ($) of the file, or nothing where it goes on in another range.
    """

    def __init__(self, of: dict):
        self.of, self.inside, self.deep, self.n = of, of["inside"], of["deep"], 0
        self.head, self.held, self.found = "^" if of["first"] else "", [], []
        self.begun = False

    def texts(self, texts: list[bytes]) -> None:
        # The cut after a text is added with the next one: the last text of a file may have none.
        self.add((CUT if self.begun else b"") + CUT.join(texts))
        self.begun = True

    def add(self, data: bytes) -> None:
        if self.of["root"] != "[":  # one value, taken whole
            self.held.append(data)
            return
        at, kinds, before, quotes = shape(data)
        outside = (before + self.inside) % 2 == 0
        at, kinds = at[outside], kinds[outside]
        self.inside = (self.inside + quotes) % 2
        deep = self.deep + np.cumsum(np.where(kinds == 2, 0, kinds), dtype=np.int64)
        if len(deep):
            self.deep = int(deep[-1])
        edge = ((kinds > 0) & (deep == 1)) | ((kinds < 0) & (deep <= 0))
        start = 0
        for i in at[edge].tolist():
            self.held.append(data[start:i])
            self.end(data[i : i + 1].decode())
            start = i + 1
        self.held.append(data[start:])

    def end(self, tail: str) -> None:
        self.found.append((self.of["rid"], self.n, self.head, tail, b"".join(self.held).decode("utf-8", "replace")))
        self.head, self.held, self.n = tail, [], self.n + 1

    def finish(self) -> None:
        if self.of["braced"]:
            self.add(CUT)
        self.end("$" if self.of["last"] else "")

    def taken(self) -> Iterator[pa.RecordBatch]:
        if self.found:
            yield _batch(self.found, PIECES)
            self.found = []


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for of, texts in _ranges(batches):
        if now is None or now.of["rid"] != of["rid"]:
            if now is not None:
                now.finish()
                yield from now.taken()
            now = Cutter(of)
        now.texts(texts)
        yield from now.taken()
    if now is not None:
        now.finish()
        yield from now.taken()


def _texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Texts between closing braces, each in the byte range it begins in, in file order."""
    file = F.col("_metadata.file_path")
    block = F.col("_metadata.file_block_start")
    return spark.read.text(path, lineSep=CUT.decode()).select(
        F.xxhash64(file, block).alias("rid"),
        F.col("value").cast("binary").alias("value"),
        file.alias("src_file"),
        block.alias("block"),
        F.col("_metadata.file_size").alias("file_size"),
    )


def range_states(profiles: DataFrame) -> DataFrame:
    """One row per byte range: the state in which a reader enters it, by composing all before it."""
    before = Window.partitionBy("src_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("src_file")
    zero = F.lit(0).cast("long")
    entered = profiles.withColumn("inside", F.coalesce(F.sum("flips").over(before), zero) % 2)
    leap = F.when(F.col("inside") == 0, F.col("deep_out")).otherwise(F.col("deep_in"))
    last = F.col("block") == F.max("block").over(whole)
    # Every text was counted with a cut; one too many means that the file ends without.
    excess = F.sum("size").over(whole) - F.col("file_size")
    return entered.withColumn("leap", leap).select(
        "rid",
        "src_file",
        "block",
        "inside",
        F.coalesce(F.sum("leap").over(before), zero).alias("deep"),
        F.first("root", ignorenulls=True).over(whole.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("root"),
        (F.col("block") == F.min("block").over(whole)).alias("first"),
        last.alias("last"),
        (~last | (excess == 0)).alias("braced"),
        excess.isin(0, 1).alias("whole"),
    )


def _joined(pieces: DataFrame) -> DataFrame:
    """Elements whose pieces lie in several ranges; a range has two such pieces at most."""
    order = Window.partitionBy("src_file").orderBy("block", "pos")
    chain = F.sum((F.col("head") != "").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    parts = F.array_sort(F.collect_list(F.struct("block", "pos", "head", "tail", "text")))
    return (
        pieces.withColumn("chain", chain)
        .groupBy("src_file", "chain")
        .agg(parts.alias("parts"))
        .select(
            "src_file",
            F.get("parts", F.lit(0))["block"].alias("block"),
            F.get("parts", F.lit(0))["pos"].alias("pos"),
            F.get("parts", F.lit(0))["head"].alias("head"),
            F.element_at("parts", -1)["tail"].alias("tail"),
            F.array_join(F.transform("parts", lambda x: x["text"]), "").alias("text"),
        )
    )


def split_elements(spark: SparkSession, path: str | list[str], scratch: str | None = None) -> DataFrame:
    """(src_file, block, pos, element) of all elements of valid files, as ``read_array_files`` has them.

    The files are scanned twice, and the cut elements written to the work folder (``scratch``), since a file is
    known to be valid only when its last element is.  The caller discards them when the rows have been read.
    """
    texts = _texts(spark, path)
    profiles = settle(texts.mapInArrow(_profiled, PROFILE), work_path(spark, "array-ranges"))
    states = settle(range_states(profiles), work_path(spark, "array-states"))
    n = states.count()
    if n != states.select("rid").distinct().count():
        raise ValueError(f"two byte ranges of {path} have one id")
    few = n <= BROADCAST_RANGES
    near = F.broadcast(states) if few else states
    entry = near.select("rid", *(F.col(c).cast("long") for c in ("inside", "deep")), "root", "first", "last", "braced")
    rows = texts.select("rid", "value", F.monotonically_increasing_id().alias("pos")).join(entry, "rid")
    if not few:
        rows = rows.sortWithinPartitions("rid", "pos")
    cut = rows.select("rid", "value", "inside", "deep", "root", "first", "last", "braced").mapInArrow(_cut, PIECES)
    pieces = cut.join(near.select("rid", "src_file", "block", "whole"), "rid").where("whole").drop("rid", "whole")
    pieces = settle(pieces, work_path(spark, "array-pieces"))
    open_ = (F.col("head") == "") | (F.col("tail") == "")
    found = pieces.where(~open_).unionByName(_joined(pieces.where(open_)))
    edges = F.concat("head", "tail")
    blank = F.translate("text", BLANK.decode(), "") == ""
    left = found.where(~(blank & edges.isin("^[", "[]", "]$")))
    element = F.when(edges.isin("[,", "[]", ",,", ",]", "^$"), F.to_json(P.whole_json(F.col("text"))))
    checked = settle(
        left.select("src_file", "block", "pos", element.alias("element")), scratch or work_path(spark, "array-elements")
    )
    bad = checked.where(F.col("element").isNull()).select("src_file").distinct()
    return checked if bad.isEmpty() else checked.join(bad, "src_file", "left_anti")
