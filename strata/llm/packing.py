"""Hierarchical packing: documents into token sequences of several lengths, cut freely.

Tiers are powers of two up to ``tiers[-1]``.  Whole windows of the longest tier are cut off a long
document; what is left is routed to the shortest tier that holds it.  Each tier is
packed from the longest piece down; the gap of a window is filled with the largest
pieces of shorter tiers that fit, and the last of it by cutting a piece.  Windows that are
full need no padding.  Windows are joined to slots of the longest tier's size, and slots
go, the most attention work first, to the step group with least work so far.

A task packs the documents it reads, in rounds of bounded size: nothing is shuffled.  What is left of
a task, less than one window of the shortest tier, is written with its ids and packed again in a
second level over the leftovers of all tasks, where one window per task may be padded.

Defined results: a NULL or empty text is the one closing id; repeated rows are packed
each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_or_empty
from strata.llm.word_ids import MODEL, encoder
from strata.session import settle, work_path

TIERS = (512, 1024, 2048, 4096)
END_ID = 2
ROUND = 2_000_000  # ids packed together
STEP = 16  # slots of a step group
_ID_BITS = 33  # a task's windows are numbered in the low bits
_SECOND = 1 << 29  # task numbers of the second level start here
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " tier int, step_group long, ids binary"
)
_ARROW = pa.schema(
    [(n, pa.int32() if n == "tier" else pa.binary() if n == "ids" else pa.int64()) for n in (f.split()[0] for f in SCHEMA.split(","))]
)


class Packer:
    """Packs pieces (length, order, doc_id, start, doc_tokens, ids) round by round."""

    def __init__(self, task: int, tiers: tuple[int, ...] = TIERS, keep_ids: bool = False):
        self.tiers, self.keep_ids = tiers, keep_ids
        self.pool: list[tuple] = []  # by length
        self.total = self.order = 0
        self.next_window = task << _ID_BITS
        self.next_group = task << _ID_BITS
        self.windows: list[tuple[int, list[tuple]]] = []

    def add(self, doc_id, start: int, doc_tokens: int, ids: np.ndarray) -> None:
        longest, at = self.tiers[-1], 0
        while len(ids) - at >= longest:
            self.windows.append((longest, [(longest, 0, doc_id, start + at, doc_tokens, ids[at : at + longest])]))
            at += longest
        if at < len(ids):
            self._put((len(ids) - at, 0, doc_id, start + at, doc_tokens, ids[at:]))

    def _put(self, piece: tuple) -> None:
        self.order += 1
        insort(self.pool, (piece[0], self.order, *piece[2:]))
        self.total += piece[0]

    def _take(self, i: int) -> tuple:
        piece = self.pool.pop(i)
        self.total -= piece[0]
        return piece

    def _cut(self, piece: tuple, n: int) -> tuple:
        """The first ``n`` ids; the others go back to the pool."""
        length, order, doc_id, start, doc_tokens, ids = piece
        if n < length:
            self._put((length - n, 0, doc_id, start + n, doc_tokens, ids[n:]))
        return (n, order, doc_id, start, doc_tokens, ids[:n])

    def pack(self, reserve: int) -> None:
        """Fill windows while more than ``reserve`` ids are left."""
        while self.pool and self.total > reserve:
            length = self.pool[-1][0]
            tier = next(t for t in self.tiers if t >= length)
            if self.total < tier:  # nothing to fill it with: the longest full window in it
                if self.total < self.tiers[0]:
                    return
                tier = max(t for t in self.tiers if t <= self.total)
            window, gap = [], tier
            while gap:
                fits = bisect_right(self.pool, (gap, self.order + 1))
                piece = self._take(fits - 1) if fits else self._cut(self._take(0), gap)
                window.append(piece)
                gap -= piece[0]
            self.windows.append((tier, window))

    def rest(self) -> None:
        """What is left as one window, whatever its length."""
        if self.pool:
            self.windows.append((0, self.pool))
            self.pool, self.total = [], 0

    def _grouped(self) -> list[int]:
        """Step group of each window of the round."""
        longest = self.tiers[-1]
        slots: list[tuple[int, list[int]]] = []
        for tier in (*reversed(self.tiers), 0):
            own = [i for i, (t, _) in enumerate(self.windows) if t == tier]
            n = longest // tier if tier else 1
            slots += [((tier or longest) * longest, own[i : i + n]) for i in range(0, len(own), n)]
        groups = -(-len(slots) // STEP)
        load = [(0, self.next_group + g) for g in range(groups)]
        self.next_group += groups
        of = [0] * len(self.windows)
        for work, members in slots:
            least, group = load[0]
            heapq.heapreplace(load, (least + work, group))
            for i in members:
                of[i] = group
        return of

    def out(self) -> pa.RecordBatch:
        rows = []
        for (tier, window), group in zip(self.windows, self._grouped()):
            offset = 0
            for length, _, doc_id, start, doc_tokens, ids in window:
                data = ids.astype("<u4", copy=False).tobytes()
                rows.append((doc_id, start, length, zlib.crc32(data), doc_tokens, self.next_window, offset, tier, group, data if self.keep_ids else None))
                offset += length
            self.next_window += 1
        self.windows = []
        return _batch(rows)

    def left(self) -> pa.RecordBatch:
        """Pieces that are not packed, with their ids."""
        rows = [(p[2], p[3], p[0], None, p[4], None, None, None, None, p[5].astype("<u4").tobytes()) for p in self.pool]
        return _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _first_level(name: str, tiers: tuple[int, ...], keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(name)
        packer = Packer(TaskContext.get().partitionId(), tiers, keep_ids)
        pending = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py(), END_ID)
                packer.add(doc_id, 0, len(ids), ids)
                pending += len(ids)
                if pending > ROUND:
                    packer.pack(reserve=4 * tiers[-1])
                    yield packer.out()
                    pending = 0
        packer.pack(reserve=0)
        yield packer.out()
        yield packer.left()

    return run


def _second_level(tiers: tuple[int, ...], keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(_SECOND + TaskContext.get().partitionId(), tiers, keep_ids)
        pending = 0
        for batch in batches:
            for doc_id, start, doc_tokens, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                ids = np.frombuffer(data, dtype="<u4")
                packer.add(doc_id, start, doc_tokens, ids)
                pending += len(ids)
                if pending > ROUND:
                    packer.pack(reserve=4 * tiers[-1])
                    yield packer.out()
                    pending = 0
        packer.pack(reserve=0)
        packer.rest()
        yield packer.out()

    return run


def pack(docs: DataFrame, name: str = MODEL, tiers: tuple[int, ...] = TIERS, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, ``start`` in its document, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence, ``tier`` (0: to be padded
    to the longest), ``step_group``, and with ``keep_ids`` the ids (little-endian,
    unsigned, 32 bits)."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    # Settled: the second level must see the leftovers of exactly these windows.
    first = settle(texts.mapInArrow(_first_level(name, tiers, keep_ids), SCHEMA), work_path(spark, "packed"))
    left = first.where(F.col("sequence_id").isNull())
    amount = left.agg(F.sum("length")).first()[0] or 0
    parts = 1 + amount // (4 * ROUND)
    again = left.select("doc_id", "start", "doc_tokens", "ids").repartition(parts, "doc_id", "start")
    second = again.mapInArrow(_second_level(tiers, keep_ids), SCHEMA)
    return first.where(F.col("sequence_id").isNotNull()).unionByName(second)
