"""Fill-in-middle: a text cut at two line ends, with its middle put last.

The units are lines with their line end.  A text is cut into blocks of ``BLOCK`` bytes; a Fenwick tree
over the blocks holds how many units end in each and how many code points begin in it.  For a cut
after k units, a binary-lifting descent finds the block in which the k-th unit ends, with the code points
before it, and the boundary is looked up inside that block alone.  Where a text is cut, and its form, follow
from a digest of the seed and ``doc_id``, so a repeated task gives the same result.

Nothing is shuffled; a task holds one batch of texts.  Defined results: a NULL text is empty; an empty
text, or one that holds a marker, stays as it is (``plain``); a NULL ``doc_id`` is written as no digits;
rows that repeat a document get the same result each; an empty table gives an empty result; other
columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_or_empty

BLOCK = 1024
# The markers of the contract, in the order prefix, suffix, middle.
MARKERS = ("<P>", "<S>", "<M>")
MOVED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Moves:
    """``rate`` and ``spm`` are percentages: texts that are cut, and of these the ones with the suffix first."""

    seed: int = 7
    rate: int = 100
    spm: int = 50


class Blocks:
    """A UTF-8 text with a Fenwick tree over its blocks: unit ends and code points."""

    def __init__(self, text: bytes, block: int = BLOCK):
        self.text, self.block = np.frombuffer(text, dtype=np.uint8), block
        self.n_blocks = -(-len(text) // block)
        starts = np.arange(0, len(text), block)
        self.open = bool(len(text)) and text[-1] != 10  # the last unit has no line end
        ends = self.text == 10
        held = np.zeros((self.n_blocks + 1, 2), dtype=np.int64)
        if self.n_blocks:
            held[1:, 0] = np.add.reduceat(ends, starts, dtype=np.int64)
            held[1:, 1] = np.add.reduceat((self.text & 0xC0) != 0x80, starts, dtype=np.int64)
            held[-1, 0] += self.open
        before = held.cumsum(axis=0)
        self.n_units = int(before[-1, 0])
        i = np.arange(self.n_blocks + 1)
        self.tree = (before - before[i - (i & -i)]).tolist()

    def cut(self, units: int) -> tuple[int, int]:
        """(bytes, code points) before the end of the ``units``-th unit."""
        if units == 0:
            return 0, 0
        at, left, chars = 0, units, 0
        step = 1 << self.n_blocks.bit_length()
        while step := step >> 1:
            if at + step <= self.n_blocks and self.tree[at + step][0] < left:
                at += step
                left, chars = left - self.tree[at][0], chars + self.tree[at][1]
        begin = at * self.block
        inside = self.text[begin : begin + self.block]
        ends = np.flatnonzero(inside == 10)
        here = int(ends[left - 1]) + 1 if left <= len(ends) else len(inside)
        return begin + here, chars + int(np.count_nonzero((inside[:here] & 0xC0) != 0x80))


def moved(doc_id: int | None, text: bytes, how: Moves = Moves()) -> tuple:
    """(units, form, code points of prefix and middle, output)."""
    digest = hashlib.sha256(f"{how.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    blocks = Blocks(text)
    n = blocks.n_units
    p, s, m = (x.encode() for x in MARKERS)
    if not text or h3 % 100 >= how.rate or p in text or s in text or m in text:
        return n, "plain", None, None, text
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, a_chars), (b, b_chars) = blocks.cut(first), blocks.cut(last)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    spm = h4 % 100 < how.spm
    output = b"".join((s, suffix, p, prefix, m, middle) if spm else (p, prefix, s, suffix, m, middle))
    return n, "spm" if spm else "psm", a_chars, b_chars - a_chars, output


def _moved(how: Moves):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = [moved(d, t.as_py(), how) for d, t in zip(ids, batch.column(1))]
            n, form, prefix, middle, output = zip(*found) if found else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.binary()).cast(pa.string()),
                ],
                names=[f.split()[0] for f in MOVED.split(", ")],
            )

    return run


def transform(docs: DataFrame, how: Moves = Moves()) -> DataFrame:
    """One row per row of ``docs``: doc_id, units, form, code points of prefix and middle (NULL
    where plain), and the output text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    return texts.mapInArrow(_moved(how), MOVED)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text again.  No piece holds a marker and no marker begins as another ends, so the output falls
    into its pieces at the markers."""
    pieces = F.split(F.col(output), "|".join(MARKERS))
    prefix, suffix = (F.when(F.col(form) == "psm", F.get(pieces, F.lit(i))).otherwise(F.get(pieces, F.lit(3 - i))) for i in (1, 2))
    return F.when(F.col(form) == "plain", F.col(output)).otherwise(F.concat(prefix, F.get(pieces, F.lit(3)), suffix))
