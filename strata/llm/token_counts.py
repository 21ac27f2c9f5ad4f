"""Token counts by byte-pair merging on a heap and a linked list, without identifiers.

A text is taken apart where the vocabulary can never merge: between characters that
stand side by side in no piece.  Each part is merged for itself: the adjacent pair of
the lowest rank is popped from a heap, merged in a linked list, and its new
neighbours are pushed.  The count is the initial symbols less the merges; a character
outside the vocabulary counts as its UTF-8 bytes.  Parts repeat, so counts of short parts are
kept in a table of bounded size.

Defined results: a NULL or empty text has no tokens; copies and repeated rows get the same
count each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_or_empty

MODEL = "piece_bpe_32k.model"
SPACE_MARK = "▁"
LIMIT = 4096
KEPT, KEPT_LENGTH = 600_000, 32


class Merger:
    """Counts tokens of parts.  ``ranks``: piece to rank, the lowest is merged first."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.known = frozenset(piece for piece in ranks if len(piece) == 1)
        inside = {(a, b) for piece in ranks for a, b in zip(piece, piece[1:])}
        self.firsts: dict[str, set[str]] = {}
        for a, b in inside:
            self.firsts.setdefault(a, set()).add(b)

    def initial(self, part: str) -> int:
        """Symbols before any merge."""
        if self.known.issuperset(part):
            return len(part)
        return sum(1 if c in self.known else len(c.encode("utf-8", "surrogatepass")) for c in part)

    def merges(self, part: str) -> int:
        """Pairs merged in ``part``, lowest rank first, the leftmost of equal ones."""
        rank_of, n = self.ranks.get, len(part)
        # One number for rank and place: the heap then compares plain integers.
        heap = [r * n + i for i in range(n - 1) if (r := rank_of(part[i : i + 2])) is not None]
        heapify(heap)
        # A symbol is known by its first character; end[i] is where it ends, 0 once it is merged away.
        end = list(range(1, n + 1))
        before = list(range(-1, n))
        done = 0
        while heap:
            rank, i = divmod(heappop(heap), n)
            j = end[i]
            if not j or j == n:
                continue
            k = end[j]
            if rank_of(part[i:k]) != rank:  # one of the two has changed since
                continue
            done += 1
            end[i], end[j] = k, 0
            before[k] = i
            if k < n and (r := rank_of(part[i : end[k]])) is not None:
                heappush(heap, r * n + i)
            if i and (r := rank_of(part[before[i] : k])) is not None:
                heappush(heap, r * n + before[i])
        return done

    def count(self, part: str) -> int:
        return self.initial(part) - (self.merges(part) if len(part) > 1 else 0)

    def cut(self, chunk: str) -> list[str]:
        """Parts of ``chunk`` between which no piece reaches."""
        firsts, parts, at = self.firsts, [], 0
        for i in range(1, len(chunk)):
            after = firsts.get(chunk[i - 1])
            if after is None or chunk[i] not in after:
                parts.append(chunk[at:i])
                at = i
        parts.append(chunk[at:])
        return parts


class _Table(dict):
    """Counts of short texts, made when asked for; emptied when it is full."""

    def __init__(self, count: Callable[[str], int]):
        super().__init__()
        self.count = count

    def __missing__(self, key: str) -> int:
        n = self.count(key)
        if len(key) <= KEPT_LENGTH:
            self[key] = n
        return n

    def bounded(self) -> None:
        if len(self) > KEPT:
            self.clear()


class TextCounter:
    """Tokens of whole texts; ``normalise`` marks blanks and puts a mark in front."""

    def __init__(self, merger: Merger, normalise: Callable[[str], str]):
        if any(SPACE_MARK in piece.lstrip(SPACE_MARK) or "\n" in piece for piece in merger.ranks):
            raise ValueError("a piece goes on after a blank, or over a line break")
        self.merger, self.normalise = merger, normalise
        self.parts = _Table(merger.count)
        self.words = _Table(lambda word: self.run(SPACE_MARK + word))

    def run(self, text: str) -> int:
        return sum(map(self.parts.__getitem__, self.merger.cut(text)))

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        self.parts.bounded()
        self.words.bounded()
        marked = self.normalise(text)
        lines = marked.split("\n")
        n = (len(lines) - 1) * self.merger.initial("\n")
        runs = SPACE_MARK * 2 in marked
        for line in lines:
            if runs:
                n += sum(map(self.run, re.findall(f"{SPACE_MARK}+[^{SPACE_MARK}]*|[^{SPACE_MARK}]+", line)))
            else:
                first, *rest = line.split(SPACE_MARK)
                n += (self.run(first) if first else 0) + sum(map(self.words.__getitem__, rest))
        return n


@lru_cache(maxsize=4)
def sentencepiece_counter(name: str = MODEL) -> TextCounter:
    """Counter that agrees with the sentencepiece library for one of its BPE models.

    Pieces, scores and the normaliser are the model's; a higher score is a lower rank.
    """
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    kinds = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    ids = [i for i in range(model.get_piece_size()) if not any(kind(i) for kind in kinds)]
    rank = {score: r for r, score in enumerate(sorted({model.get_score(i) for i in ids}, reverse=True))}
    return TextCounter(Merger({model.id_to_piece(i): rank[model.get_score(i)] for i in ids}), model.normalize)


def _counted(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = sentencepiece_counter(name)
        for batch in batches:
            n = [count(text.as_py()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    return run


def token_counts(docs: DataFrame, name: str = MODEL, limit: int = LIMIT) -> DataFrame:
    """doc_id, ``n_bytes`` (UTF-8), ``n_tokens`` without begin and end, ``over_limit``.
    A batch of texts is counted where it is read; nothing is shuffled."""
    text = text_or_empty()
    texts = docs.select(F.col("doc_id").cast("long"), F.octet_length(text).cast("long"), text.alias("text"))
    counted = texts.mapInArrow(_counted(name), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
