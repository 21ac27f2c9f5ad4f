"""Source divergence against a dense interpreter of its definition."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SHAPE = "doc_id long, text string, lang string, source string"


def plain_audit(docs, min_docs, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in docs:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = TERM.findall((text or "").translate(lower))
        count[lang, source].update(found)
        held[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= min_docs]
        v = len(kept)

        def shares(n):
            total = sum(n[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (n[t] + 2) // (total + 2 * v) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            over = [(f(p[s][t], q[t]), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, rows in (("pair", pairs), ("term", over)):
                ranked = sorted(rows, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, x, value, i) for i, (value, x) in enumerate(ranked, 1) if part == "pair" or i <= top]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


def test_audit_of_odd_documents(odd, plain, empty):
    assert found(divergence.audit(odd)) == plain_audit(plain, 10, 10)
    assert divergence.audit(empty).count() == 0


@pytest.mark.parametrize("least, entries, block", [(1, 7, 5), (2, 10**6, 10**6), (400, 50, 50)])
def test_audit_of_any_blocks(llm, monkeypatch, least, entries, block):
    """Small flushes and blocks; groups without kept terms, one source alone, NULLs, ties, copies."""
    rng = random.Random(8)
    word = lambda i: ["eau", "Él", "x", "zz", "the"][i % 5] + "abcdefgh"[i % 8] * (i // 40)
    docs = [
        (i, " ".join(word(min(rng.randrange(300), rng.randrange(300))) for _ in range(rng.randrange(30))), f"l{i % 3}", f"s{i % 7}")
        for i in range(150)
    ]
    docs += [(None, None, None, None), (1, "", "l0", "none"), (2, "12 34 _", "l1", None), (3, "alone alone", "l9", "only")]
    docs += [docs[5]] * 4
    monkeypatch.setattr(divergence, "ENTRIES", entries)
    batch = pa.RecordBatch.from_pylist([{"l": d[2] or "", "s": d[3] or "", "t": (d[1] or "").encode()} for d in docs])
    words = sum(len(divergence.terms((d[1] or "").encode())) for d in docs)
    assert sum(sum(b["n"].to_pylist()) for b in divergence._counted(iter([batch]))) == words
    frame = llm.createDataFrame(docs, SHAPE).repartition(4)
    index = divergence.term_index(frame, least)
    monkeypatch.setattr(divergence, "BROADCAST_ROWS", 0 if least == 1 else 10**6)
    monkeypatch.setattr(divergence.pair_values, "__defaults__", (block,))
    held = Counter((d[2] or "", t) for d in docs for t in set(divergence.terms((d[1] or "").encode())))
    assert index.count() == sum(n >= least for n in held.values())
    assert found(divergence.audit(frame, least)) == plain_audit(docs, least, 10)


def test_scatter_is_the_difference_to_the_baseline():
    rng = np.random.default_rng(2)
    n_terms, n_groups = 40, 6
    counts = rng.integers(0, 3, (n_terms, n_groups))
    z = rng.integers(1, 50, n_groups)
    p = np.where(counts > 0, counts * 100 + z, z)
    term, group = np.nonzero(counts)
    got = np.zeros((n_groups, n_groups), dtype=np.int64)
    for g, met, value in divergence.scatter(term, group, p[term, group], z):
        got[g, met] = value
    f = divergence.gaps
    for g in range(n_groups):
        for h in range(n_groups):
            if g != h:
                base = (
                    f(p[counts[:, g] > 0, g], z[h]).sum()
                    + f(z[g], p[counts[:, h] > 0, h]).sum()
                    + (n_terms - (counts[:, g] > 0).sum() - (counts[:, h] > 0).sum()) * f(z[g], z[h])
                )
                assert base + got[g, h] == f(p[:, g], p[:, h]).sum()


def test_shares_of_counts_beyond_64_bits(llm):
    big = 4_000_000_000_000_000
    frame = llm.createDataFrame([(big, 3 * big, 7), (0, 0, 0)], "n long, total long, v long")
    got = [r[0] for r in frame.select(divergence.share(*(frame[c] for c in frame.columns))).collect()]
    assert sorted(got) == sorted([1 + 10**9 * (big + 2) // (3 * big + 14), 1])
