"""Line dedup: long lines that many documents share stay in one of them only.

Keys of lines are hashed (128 bits); the hashes are range partitioned with a
secondary sort by document (largest first) and position, and streamed: the first
document met keeps the line, the others lose it.  The result is one compressed bitmap per
document that loses lines, not text.

The range bounds take in the document, so a key that a third of all lines share is
spread over many tasks.  A task cannot judge its first key, which may have begun
in the task before, nor a last key with few documents so far; it passes on those rows and a
summary of at most two keys, and the summaries of all tasks settle them.

Defined results: a NULL or empty text is one empty line; rows that repeat a document
get the same result and count as one document; a NULL ``doc_id`` counts as the
smallest one; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import SPACE_CHARS, packed, text_or_empty, unpacked
from strata.session import discard, settle, work_path

MIN_CHARS, MIN_DOCS = 40, 5
DROP, OPEN, SUMMARY = 0, 1, 2
NO_ID = -(1 << 63)  # stands for a NULL doc_id
KEYED = "h1 long, h2 long, doc long, text_hash long, pos long"
_BLANK = SPACE_CHARS.encode()


def line_key(line: bytes) -> bytes:
    """A line without outer white space, A-Z lower-cased (bytes.lower touches no others)."""
    return line.strip(_BLANK).lower()


def _keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, rows, places = [], [], []
            for row, text in enumerate(batch.column(2)):
                for pos, line in enumerate(text.as_py().lower().split(b"\n")):
                    key = line.strip(_BLANK) if len(line) >= min_chars else b""
                    if len(key) < min_chars:
                        continue
                    if len(key) < 4 * min_chars and not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars:
                        continue
                    digests.append(xxhash.xxh3_128_digest(key))
                    rows.append(row)
                    places.append(pos)
            halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            picked = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    batch.column(0).take(picked),
                    batch.column(1).take(picked),
                    pa.array(places, pa.int64()),
                ],
                names=["h1", "h2", "doc", "text_hash", "pos"],
            )

    return run


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line whose key is long enough: hash, document, position."""
    texts = docs.select(_doc(), _text_hash(), text_or_empty().cast("binary").alias("text"))
    return texts.mapInArrow(_keys(min_chars), KEYED)


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc")


def _text_hash() -> Column:
    return F.xxhash64(text_or_empty()).alias("text_hash")


def _starts(*cols: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before in any column; the first row does."""
    new = np.zeros(len(cols[0]), dtype=bool)
    new[:1] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    return new


class _Stream:
    """Judges the sorted lines of one range, batch by batch.

    Holds one group at a time: its key, documents so far, largest document, and its rows
    only while it has fewer than ``min_docs`` documents.
    """

    def __init__(self, min_docs: int):
        self.min_docs = min_docs
        self.key = None  # of the group that is open
        self.mode = None  # "first" of the range, "sure" to be over the limit, "few"
        self.n = self.top = self.last = 0
        self.held: pd.DataFrame | None = None

    def _out(self, rows: pd.DataFrame, kind: int) -> pd.DataFrame:
        return rows.assign(kind=kind)

    def _summary(self) -> pd.DataFrame:
        row = {"h1": [self.key[0]], "h2": [self.key[1]], "doc": [self.top], "text_hash": [0], "pos": [self.n]}
        return self._out(pd.DataFrame(row, dtype="int64"), SUMMARY)

    def batch(self, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if self.held is not None:
            rows, self.held, self.key = pd.concat([self.held, rows], ignore_index=True), None, None
        h1, h2, doc = (rows[c].to_numpy() for c in ("h1", "h2", "doc"))
        if self.mode is None and len(rows):
            self.key, self.mode, self.n, self.top, self.last = (h1[0], h2[0]), "first", 0, doc[0], None
        group = _starts(h1, h2)
        first = 0
        if self.key is not None and len(rows) and (h1[0], h2[0]) == self.key:
            ends = np.flatnonzero(group[1:])
            first = int(ends[0]) + 1 if len(ends) else len(rows)
            own, docs = rows.iloc[:first], doc[:first]
            self.n += int(_starts(docs).sum()) - int(self.last is not None and docs[0] == self.last)
            self.last = docs[-1]
            yield self._out(own, OPEN) if self.mode == "first" else self._out(own[docs != self.top], DROP)
        if first == len(rows):
            return
        if self.mode == "first":  # its group ends here
            yield self._summary()
        rows, h1, h2, doc, group = rows.iloc[first:], h1[first:], h2[first:], doc[first:], group[first:].copy()
        group[0] = True
        at = np.flatnonzero(group)
        held_by = np.add.reduceat(_starts(h1, h2, doc).astype(np.int64), at)
        of = np.cumsum(group) - 1
        drop = (held_by[of] >= self.min_docs) & (doc != doc[at][of])
        last = int(at[-1])
        if held_by[-1] < self.min_docs:
            self.key, self.mode, self.held = (h1[last], h2[last]), "few", rows.iloc[last:]
        else:
            self.key, self.mode = (h1[last], h2[last]), "sure"
        self.n, self.top, self.last = int(held_by[-1]), doc[last], doc[-1]
        yield self._out(rows[drop], DROP)

    def end(self) -> Iterator[pd.DataFrame]:
        if self.mode is None:
            return
        if self.held is not None:
            yield self._out(self.held, OPEN)
        yield self._summary()


def _judge(min_docs: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stream = _Stream(min_docs)
        for rows in frames:
            if len(rows):
                yield from stream.batch(rows)
        yield from stream.end()

    return run


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, text_hash, pos) of every line that goes."""
    spark = docs.sparkSession
    keyed_at = work_path(spark, "line-keys")
    keyed = settle(keyed_lines(docs, min_chars), keyed_at)
    ranged = keyed.repartitionByRange("h1", "h2", F.desc("doc")).sortWithinPartitions("h1", "h2", F.desc("doc"), "pos")
    judged = settle(ranged.mapInPandas(_judge(min_docs), f"{KEYED}, kind int"), work_path(spark, "line-drops"))
    discard(spark, keyed_at)
    place = ["doc", "text_hash", "pos"]
    # At most two summaries a task: bounded by the number of ranges.
    over = (
        judged.where(F.col("kind") == SUMMARY)
        .groupBy("h1", "h2")
        .agg(F.sum("pos").alias("n"), F.max("doc").alias("top"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "top")
    )
    late = judged.where(F.col("kind") == OPEN).join(F.broadcast(over), ["h1", "h2"]).where(F.col("doc") != F.col("top"))
    return judged.where(F.col("kind") == DROP).select(*place).unionByName(late.select(*place))


@F.pandas_udf(T.BinaryType())
def keep_bitmap(positions: pd.Series) -> pd.Series:
    """Compressed bits, 1 for a line that stays, up to the byte of the last one that goes."""

    def bits(gone: np.ndarray) -> bytes:
        keep = np.ones(int(gone.max()) // 8 * 8 + 8, dtype=np.uint8)
        keep[gone] = 0
        return zlib.compress(np.packbits(keep).tobytes())

    return positions.map(bits)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document that loses lines: ``k_doc``, ``k_hash``, ``n_dropped``, ``keep``.
    Documents without a row keep all lines."""
    gone = dropped_lines(docs, min_chars, min_docs).groupBy("doc", "text_hash").agg(F.collect_set("pos").alias("gone"))
    return gone.select(
        F.col("doc").alias("k_doc"),
        F.col("text_hash").alias("k_hash"),
        F.size("gone").cast("long").alias("n_dropped"),
        keep_bitmap("gone").alias("keep"),
    )


def kept_text(text: str, keep: bytes) -> str:
    """The lines of a text that its bitmap keeps."""
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), dtype=np.uint8))
    return "\n".join(x for i, x in enumerate(lines) if i >= len(bits) or bits[i])


@F.pandas_udf(T.StringType())
def _kept(text: pd.Series, keep: pd.Series) -> pd.Series:
    return pd.Series([t if k is None else kept_text(t, k) for t, k in zip(text, keep)], dtype=object)


def applied(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Every row of ``docs`` in ``row`` with its kept text, ``n_lines`` and ``n_dropped``."""
    rows = packed(docs, _doc(), _text_hash(), text_or_empty().alias("t"))
    marked = rows.join(
        keep_bitmaps(docs, min_chars, min_docs),
        (F.col("doc") == F.col("k_doc")) & (F.col("text_hash") == F.col("k_hash")),
        "left",
    )
    return marked.select(
        "row",
        F.when(F.col("keep").isNull(), F.col("t")).otherwise(_kept("t", "keep")).alias("kept"),
        F.size(F.split("t", "\n")).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
    )


def without_repeats(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents without the lines that go; ``n_chars`` follows the text."""
    return unpacked(applied(docs, min_chars, min_docs), docs, text=F.col("kept"), n_chars=F.char_length("kept"))
