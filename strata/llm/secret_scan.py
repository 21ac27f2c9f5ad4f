"""Secret scans: parts of credentials, linked where they stand together.

A credential has parts of three roles: an access identifier, a secret, an endpoint.  Strong parts (an
assigned secret, an access key, a run of hexadecimal digits) are found by their form and always reported.
Weak parts (a user name, a token that looks random, an address) are found by form too but mean little alone.  They
are reported only where a part that completes them stands near: the scopes of a text (paragraphs, sections)
are intervals, every part opens a window of ``reach`` code points within its scope, and an interval join of
the windows with the parts of the other role decides.  Secrets complete identifiers and endpoints, and the
other way round.  Linked parts whose windows touch form one credential.

A scope never leaves its document, so the join needs no shuffle: both sides are sorted by position and met by
binary search, in time and memory in proportion to the parts of one document, without pairs.

Defined results: a NULL text is empty; rows that repeat a document get the same result each; equal
places are ordered by kind; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_or_empty

# Kinds of spans in the order of the contract, then those of the method.
KINDS = ("assign", "access", "hex", "id", "key", "endpoint")
BASE = KINDS[:3]
# Patterns of the contract.  On bytes, (?i) touches A-Z alone.
ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")

IDENTIFIER = re.compile(rb"""\b(?i:access_?key_?id|client_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]{3,}""")
TOKEN = re.compile(rb"[A-Za-z0-9+/_-]{20,}={0,2}")
ENDPOINT = re.compile(rb"""[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{3,}|(?:[a-z0-9-]+\.)+[a-z0-9-]+:[0-9]{2,5}(?![0-9])""")
BREAK = re.compile(rb"\n[\x20\t\r]*\n|\n(?=\[[^\]\n]*\][\x20\t\r]*\n)|\n(?=---)")

SPANS = "array<struct<kind:string,start:long,end:long,linked:boolean>>"
FOUND = f"doc_id long, spans {SPANS}, credentials array<struct<start:long,end:long,parts:long>>"


@dataclass(frozen=True)
class Linking:
    """``reach``: code points between parts that belong together; ``entropy``: bits a
    character of a token that looks random; least sizes of the strong parts."""

    reach: int = 400
    entropy: float = 3.5
    assign_chars: int = 12
    access_chars: int = 18


def looks_random(token: bytes, entropy: float) -> bool:
    """Upper case, lower case and digits, and few repeats."""
    if not (re.search(rb"[A-Z]", token) and re.search(rb"[a-z]", token) and re.search(rb"[0-9]", token)):
        return False
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values()) >= entropy


def strong_parts(text: bytes, how: Linking = Linking()) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes, in order within a kind."""
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= how.assign_chars]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= how.access_chars]
    return found + [(*m.span(), "hex") for m in HEX.finditer(text)]


def weak_parts(text: bytes, strong: list[tuple[int, int, str]], how: Linking = Linking()) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes, but for those that meet a strong part or a weak one of an earlier kind."""
    found: list[tuple[int, int, str]] = []
    taken = sorted(strong)

    def add(kind: str, spans) -> None:
        nonlocal taken
        lo, hi = _sides(np.array([x[:2] for x in taken], dtype=np.int64).reshape(-1, 2))
        for a, b in spans:
            k = int(np.searchsorted(lo, b))
            if not k or hi[k - 1] <= a:
                found.append((a, b, kind))
        taken = sorted([*strong, *found])

    if b"://" in text or re.search(rb":[0-9]", text):
        add("endpoint", (m.span() for m in ENDPOINT.finditer(text)))
    add("id", (m.span() for m in IDENTIFIER.finditer(text)))
    add("key", (m.span() for m in TOKEN.finditer(text) if looks_random(m[0], how.entropy)))
    return found


def _sides(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted starts, and the largest end up to each."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    return spans[:, 0], np.maximum.accumulate(spans[:, 1]) if len(spans) else spans[:, 1]


def windows(spans: np.ndarray, breaks: np.ndarray, reach: int) -> np.ndarray:
    """Each span widened by ``reach`` on both sides, inside its scope.  ``breaks``: where scopes begin."""
    scope = np.searchsorted(breaks, spans[:, 0], side="right")
    bounds = np.concatenate([[0], breaks, [np.iinfo(np.int64).max]])
    low = np.maximum(spans[:, 0] - reach, bounds[scope])
    return np.stack([low, np.minimum(spans[:, 1] + reach, bounds[scope + 1])], axis=1)


def met(window: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Interval join: whether any of ``others`` meets the window."""
    if not len(others):
        return np.zeros(len(window), dtype=bool)
    lo, hi = _sides(others)
    k = np.searchsorted(lo, window[:, 1], side="left")
    return (k > 0) & (hi[np.maximum(k, 1) - 1] > window[:, 0])


def code_points(text: bytes, places: np.ndarray) -> np.ndarray:
    """Code points before each of the byte places."""
    if text.isascii():
        return places
    begins = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(begins)])[places]


def credential_spans(text: bytes, how: Linking = Linking()) -> tuple[list[tuple], list[tuple]]:
    """((kind, start, end, linked), ...) of the reported spans, and ((start, end, parts), ...)
    of the credentials, in code points."""
    strong = strong_parts(text, how)
    parts = strong + weak_parts(text, strong, how)
    if not parts:
        return [], []
    spans = code_points(text, np.array([x[:2] for x in parts], dtype=np.int64))
    kinds = np.array([KINDS.index(x[2]) for x in parts])
    breaks = code_points(text, np.array([m.end() for m in BREAK.finditer(text)], dtype=np.int64))
    assign, access, hexadecimal, ident, key, endpoint = range(6)
    secret = np.isin(kinds, (assign, hexadecimal, key))
    window = windows(spans, breaks, how.reach)
    linked = np.where(secret, met(window, spans[~secret]), met(window, spans[secret]))
    order = np.lexsort((kinds, spans[:, 0]))
    told = [
        (KINDS[kinds[i]], int(spans[i, 0]), int(spans[i, 1]), bool(linked[i]))
        for i in order
        if kinds[i] < ident or linked[i]
    ]
    whole: list[list[int]] = []
    for i in order[linked[order]]:
        if whole and spans[i, 0] <= whole[-1][3]:
            last = whole[-1]
            last[1], last[2], last[3] = max(last[1], int(spans[i, 1])), last[2] + 1, max(last[3], int(window[i, 1]))
        else:
            whole.append([int(spans[i, 0]), int(spans[i, 1]), 1, int(window[i, 1])])
    return told, [tuple(x[:3]) for x in whole]


def _scanned(how: Linking):
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("linked", pa.bool_())]))
    whole_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("parts", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [credential_spans(t.as_py(), how) for t in batch.column(1)]
            spans = [[dict(zip(("kind", "start", "end", "linked"), s)) for s in f[0]] for f in found]
            whole = [[dict(zip(("start", "end", "parts"), s)) for s in f[1]] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, spans_type), pa.array(whole, whole_type)],
                names=["doc_id", "spans", "credentials"],
            )

    return run


def scan(docs: DataFrame, how: Linking = Linking()) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``spans`` by start and kind, and ``credentials``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    return texts.mapInArrow(_scanned(how), FOUND)


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_spans() -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*BASE))
