"""The operators against plain interpreters of their definitions, on odd documents."""

import hashlib
import json
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import check
import corpus_pipeline
from strata.llm import (
    components,
    fingerprints,
    license_scan,
    line_dedup,
    packing,
    quality_rules,
    queries,
    segmentation,
    sharding,
    shingle_dedup,
    simhash,
    token_counts,
    tool_calls,
)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def same(a, b):
    assert sorted(a, key=repr) == sorted(b, key=repr)


@pytest.mark.parametrize("name", sorted(queries.oracles()))
def test_queries_with_sql(llm, monkeypatch, name):
    monkeypatch.setattr(check.contract, "queries", queries.runners)
    monkeypatch.setattr(check.contract, "oracle_sql", queries.oracles)
    con = check.connect(SF)
    assert check.compare(llm, con, SF, name) is None


@pytest.mark.parametrize("name", ["op1_quality_rules", "op3_license_scans"])
def test_native_queries_run_no_python(llm, name):
    text = queries.runners()[name](llm, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)


# -- quality rules ---------------------------------------------------------------


def plain_quality(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(grams)
    again = {i + d for i, g in enumerate(grams) if many[g] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again)


def test_text_rules(odd, plain):
    found = quality_rules.verdicts(odd).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    expected = []
    for d, t, *_ in plain:
        n = plain_quality(t)
        expected.append((d, *n, n[0] < 50 or 100 * n[4] > 50 * n[0]))
    same(rows(found, "*"), expected)


def test_frequent_lines_go_and_copies_stay(docs, plain, empty):
    found = {r.doc_id: r for r in quality_rules.verdicts(docs).collect()}
    assert all(found[i].lines_removed == 1 and found[i].kept for i in range(100, 130))
    assert all(found[i].lines_removed == 0 for i in [*range(200, 208), *range(220, 228)])
    texts = {r.doc_id: r.text for r in quality_rules.kept_documents(docs).collect()}
    original = {d: t for d, t, *_ in plain}
    assert texts[100] == "\n".join(x for i, x in enumerate(original[100].split("\n")) if i != 1)
    assert texts[200] == original[200]
    assert quality_rules.kept_documents(empty).count() == quality_rules.verdicts(empty).count() == 0


def test_depleted_documents_are_rejected(llm):
    rng = random.Random(1)
    line = " ".join(["menu"] * 70)
    docs = [(i, f"{line}\n{' '.join(str(rng.random()) for _ in range(5))}", "h") for i in range(20)]
    frame = llm.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, source string, x int")
    out = quality_rules.verdicts(frame, quality_rules.Rules(max_repeat_percent=101)).collect()
    assert all(r.depleted and not r.kept and not r.base_failed for r in out) and len(out) == 20


def quality_frame(llm, docs):
    """Documents (text, host), numbered."""
    return llm.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id long, text string, source string")


@pytest.mark.parametrize("shared", [1, 2, 3])
def test_shared_lines_that_are_the_longest_of_every_page_go(llm, shared):
    rng = random.Random(3)
    furniture = [f"notice {n} " + " ".join(str(rng.random()) for _ in range(40)) for n in range(shared)]
    pages = ["\n".join([*furniture, "menu home", " ".join("abcdefghij"[rng.randrange(10)] * 3 for _ in range(8))]) for _ in range(20)]
    assert len(set(pages)) == 20
    out = quality_rules.verdicts(quality_frame(llm, [(p, "h") for p in pages])).collect()
    assert len(out) == 20 and all(r.lines_removed == shared + 1 and r.depleted and not r.kept for r in out)


def test_frequent_lines_of_hosts_equal_the_sql(llm, tmp_path, monkeypatch):
    """Hosts with shared lines and copies: the check SQL counts as the code does."""
    rng = random.Random(8)
    prose_ = lambda n: " ".join(str(rng.random()) for _ in range(n))
    shared = [prose_(30), prose_(40), "menu home about"]
    docs = [("\n".join([*shared[: i % 4], prose_(12)]), f"h{i % 2}") for i in range(60)]
    docs += [docs[7]] * 80 + [(prose_(60), "h0")] * 500 + [(None, None), ("", "h1")] + [("\n".join(shared), "h2")] * 30
    docs += [(f"{shared[0]}\n{prose_(3)}", None) for _ in range(12)]
    quality_frame(llm, docs).coalesce(1).write.parquet(str(tmp_path / "w"))
    (tmp_path / "documents.parquet").symlink_to(next((tmp_path / "w").glob("part-*")))
    for name in check.TABLES:
        if name != "documents":
            (tmp_path / f"{name}.parquet").symlink_to(f"{SF}/{name}.parquet")
    monkeypatch.setattr(check.contract, "queries", queries.runners)
    monkeypatch.setattr(check.contract, "oracle_sql", queries.oracles)
    assert check.compare(llm, check.connect(str(tmp_path)), str(tmp_path), "op1_quality_rules") is None


def test_copies_do_not_raise_the_limit_of_their_host(llm):
    rng = random.Random(4)
    pages = [f"menu {'of this site ' * 5}\n{' '.join(str(rng.random()) for _ in range(60))}" for _ in range(12)]
    copy = " ".join(str(rng.random()) for _ in range(60))
    out = quality_rules.verdicts(quality_frame(llm, [(p, "h") for p in pages] + [(copy, "h")] * 700)).collect()
    assert len(out) == 712 and all(r.lines_removed == (r.doc_id < 12) for r in out)


# -- line dedup --------------------------------------------------------------------


def plain_line_dedup(table, min_docs=5):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    held = defaultdict(set)
    for d, t in table:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                held[key(line)].add(-math.inf if d is None else d)
    out = []
    for d, t in table:
        lines = (t or "").split("\n")
        own = -math.inf if d is None else d
        left = [x for x in lines if len(held.get(key(x), ())) < min_docs or max(held[key(x)]) == own]
        out.append((d, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


@pytest.mark.parametrize("parts", [1, 40])
def test_line_dedup(llm, odd, plain, parts):
    llm.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = rows(line_dedup.applied(odd).select("row.doc_id", "n_lines", "n_dropped", "kept"), "*")
    finally:
        llm.conf.set("spark.sql.shuffle.partitions", 8)
    same(found, plain_line_dedup([r[:2] for r in plain]))


def test_a_line_over_many_ranges(llm):
    line = "x" * 50
    table = [(i, f"{line}\n{i}") for i in range(3000)] + [(5000 + i, "y" * 45) for i in range(4)]
    frame = llm.createDataFrame(table, "doc_id long, text string")
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = rows(line_dedup.applied(frame).select("row.doc_id", "n_lines", "n_dropped", "kept"), "*")
    finally:
        llm.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    same(found, plain_line_dedup(table))


def test_line_stream_in_any_batches():
    import pandas as pd

    rng = random.Random(3)
    lines = sorted((rng.randrange(6), 0, -rng.randrange(12), 1, rng.randrange(4)) for _ in range(300))
    frame = pd.DataFrame([(a, b, -d, t, p) for a, b, d, t, p in dict.fromkeys(lines)], columns=["h1", "h2", "doc", "text_hash", "pos"])
    whole = None
    for size in (1, 3, 7, 50, 1000):
        out = pd.concat(line_dedup._judge(5)(iter([frame[i : i + size].reset_index(drop=True) for i in range(0, len(frame), size)])))
        got = sorted(map(tuple, out.to_numpy().tolist()))
        whole = whole or got
        assert got == whole


def test_line_bitmaps_round_trip():
    import pandas as pd

    text = "\n".join(map(str, range(20)))
    for gone in ([0], [3, 8], [19], list(range(20))):
        keep = line_dedup.keep_bitmap.func(pd.Series([np.array(gone)]))[0]
        assert line_dedup.kept_text(text, keep) == "\n".join(str(i) for i in range(20) if i not in gone)


def test_line_dedup_keeps_columns(odd, empty):
    assert line_dedup.without_repeats(odd).columns == odd.columns
    assert line_dedup.without_repeats(empty).count() == 0


# -- SimHash -------------------------------------------------------------------------


def plain_simhash(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(words)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = list(fps)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def expected_near(plain):
    fp = [plain_simhash(r[1]) for r in plain]
    root = plain_components(dict.fromkeys(fp))
    first = {}
    for r, f in zip(plain, fp):
        if r[0] is not None:
            first[root[f]] = min(first.get(root[f], r[0]), r[0])
    return [(r[0], f"{f:016x}", first.get(root[f])) for r, f in zip(plain, fp)]


@pytest.mark.parametrize("crowd", [256, 2])
def test_simhash(odd, plain, crowd):
    found = simhash.near_duplicates(odd, crowd=crowd).select("doc_id", simhash.fingerprint_text(), "component_id")
    same(rows(found, "*"), expected_near(plain))


@pytest.mark.parametrize("crowd", [1000, 5])
def test_close_fingerprints_are_linked_in_crowds_too(llm, crowd):
    rng = random.Random(2)
    fps = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for _ in range(30)}
    nodes = llm.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    edges = simhash.links(nodes, crowd=crowd)
    roots = {r.node: r.root for r in components.component_roots(edges, "a", "b").collect()}
    expected = plain_components(fps)
    groups = defaultdict(set)
    for f in fps:
        signed = f - (1 << 64) if f >> 63 else f
        groups[roots.get(signed, signed)].add(f)
    wanted = defaultdict(set)
    for f, r in expected.items():
        wanted[r].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_a_chain(llm):
    edges = llm.createDataFrame([(i, i + 1) for i in range(70)] + [(200, 200), (100, 101)], "a long, b long")
    found = {r.node: r.root for r in components.component_roots(edges, "a", "b").collect()}
    assert found == {**{i: 0 for i in range(71)}, 100: 100, 101: 100}


def test_one_of_each(odd, plain, empty):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    fp = {plain_simhash(r[1]) for r in plain}
    assert kept.count() == len(set(plain_components(fp).values()))
    assert simhash.one_of_each(empty).count() == 0


def word_shingles(text):
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def alike_groups(texts):
    """Groups of texts whose sets of five-word shingles are alike to 0.8, by comparing every two."""
    sets = [word_shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


def edited_words(rng, words, edits):
    out = list(words)
    for at in rng.sample(range(5, len(words) - 5), edits):
        out[at] = f"e{rng.randrange(10**9)}"
    return out


def family(kind):
    """Texts of one kind: pairs, a hub, chains, a template, a mixture."""
    rng = random.Random(kind)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    texts = []
    if kind == "pairs":
        for edits in [1, 2, 4, 6, 8, 9, 10, 11, 12, 16] * 4:
            own = words(450)
            texts += [own, edited_words(rng, own, edits)]
        hot = words(300)
        texts += [[*hot[:at], f"e{at}", *hot[at + 1 :]] for at in range(0, 300, 5)]
    elif kind == "hub":  # copies are alike to the original alone
        hub = words(400)
        texts = [edited_words(rng, hub, 8) for _ in range(300)]
        texts.insert(151, hub)
    elif kind == "two hubs":  # of one template: no text of one is alike to one of the other
        base = words(400)
        for hub in (edited_words(rng, base, 12), edited_words(rng, base, 12)):
            texts += [hub, *(edited_words(rng, hub, 7) for _ in range(80))]
    elif kind == "chain":  # each link is alike to the next, the ends are not
        own = words(400)
        for _ in range(60):
            texts.append(own)
            own = edited_words(rng, own, 6)
    elif kind == "template":  # much in common and nothing alike
        base = words(400)
        texts = [edited_words(rng, base, 11) for _ in range(120)]
    return [" ".join(t) for t in texts] + ["", " ", " ".join(texts[0])]


@pytest.mark.parametrize("kind", ["pairs", "hub", "two hubs", "chain", "template"])
def test_the_stage_links_what_is_alike_to_four_fifths(llm, monkeypatch, kind):
    texts = family(kind)
    root = alike_groups(texts)
    monkeypatch.setattr(shingle_dedup, "_PART", 50)
    frame = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.doc_id: r.root for r in shingle_dedup.near_duplicates(frame).collect()}
    groups = defaultdict(set), defaultdict(set)
    for i, r in enumerate(root):
        groups[0][r].add(i)
        groups[1][found[i]].add(i)
    same(map(sorted, groups[0].values()), map(sorted, groups[1].values()))
    if kind == "hub":
        assert max(map(len, groups[0].values())) == 302


def test_the_stage_compares_two_nodes_in_their_first_shared_band_alone():
    drawn = bytes(shingle_dedup.MINIMA)
    names = "key salt side node label signature crowds".split()
    rows = [
        (key, 0, side, bytes([n]), bytes([n]), drawn, [1, 2, 3] if n < 4 else [2, 3])
        for key in (1, 2, 3)
        for side, members in ((0, (1, 2, 5)), (1, (1, 2, 3, 4, 5, 6)))
        for n in members
        if key > 1 or n < 4
    ]
    found = []
    for size in (1, 2, len(rows)):
        batches = (pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[i : i + size]]) for i in range(0, len(rows), size))
        out = [(a[0], b[0]) for batch in shingle_dedup._plausible(batches) for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist())]
        assert len(out) == len(set(out))
        found.append(sorted(out))
    assert found[0] == found[1] == found[2] == [(a, b) for a in range(1, 7) for b in range(a + 1, 7) if {a, b} & {1, 2, 5}]


def test_links_of_later_rounds_join_the_groups_before(llm):
    rng = random.Random(11)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(70)]
    root = list(range(80))
    for a, b in edges:
        low, high = sorted((root[a], root[b]))
        root = [low if r == high else r for r in root]
    name = lambda i: bytes([i])
    roots = llm.createDataFrame([], "node binary, root binary")
    for at in range(0, len(edges), 24):
        known = {r.node: r.root for r in roots.collect()}
        fresh = [(*map(name, e), *(bytes(known.get(name(x), name(x))) for x in e)) for e in edges[at : at + 24] if e[0] != e[1]]
        roots = shingle_dedup.joined_roots(roots, llm.createDataFrame(fresh, shingle_dedup.LINKS))
    found = {r.node[0]: r.root[0] for r in roots.collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {i: root[i] for i in linked}


def test_the_stage_marks_odd_rows(odd, plain, empty):
    found = shingle_dedup.near_duplicates(odd).collect()
    assert len(found) == len(plain)
    by_text = defaultdict(set)
    for (_, t, *_), r in zip(sorted(plain, key=lambda r: xxhash.xxh64_intdigest((r[1] or "").encode(), 42)), sorted(found, key=lambda r: r.text_hash % 2**64)):
        by_text[t or ""].add(r.root)
    assert all(len(x) == 1 for x in by_text.values())
    assert shingle_dedup.near_duplicates(empty).count() == 0


def test_the_stage_keeps_one_of_texts_that_are_alike(llm):
    rng = random.Random(7)
    words = [f"w{rng.randrange(5000)}" for _ in range(450)]
    edited = [f"e{i}" if i % 50 == 25 else w for i, w in enumerate(words)]
    docs = [(1, " ".join(words)), (2, " ".join(edited))]
    a, b = (word_shingles(t) for _, t in docs)
    assert 5 * len(a & b) >= 4 * len(a | b) and len(simhash.one_of_each(llm.createDataFrame(docs, "doc_id long, text string")).collect()) == 2
    kept = corpus_pipeline.near_duplicates(llm, llm.createDataFrame(docs, "doc_id long, text string"), SF).collect()
    assert [r.doc_id for r in kept] == [1]


# -- tokens ---------------------------------------------------------------------------


def test_token_counts(odd, plain, empty):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    expected = []
    for d, t, *_ in plain:
        n = len(model.encode(t or ""))
        expected.append((d, len((t or "").encode()), n, n > 4096))
    same(rows(token_counts.token_counts(odd), "*"), expected)
    assert token_counts.token_counts(empty).count() == 0


def test_token_counts_of_odd_strings():
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    count, rng = token_counts.sentencepiece_counter(), random.Random(4)
    letters = "aabbeetth   ▁▁\n\n.,;\"'(){}\\ÀéßñЖ中文①😀\t\r\0\xa0ﬁ0123<s></s>_-=+"
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randrange(50)))
        assert count(text) == len(model.encode(text)), text


def whole_ids(text, tokenizer=Tokenizer.from_file(public_tokenizers.path(packing.MODEL))):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def test_word_ids_are_the_librarys():
    from strata.llm.word_ids import encoder

    rng = random.Random(6)
    letters = "aBcdeİΣßéÉ́ 's't  \n\x1c\x85 .,!?1²中😀<|endoftext|>ﬁ"
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randrange(40)))
        assert encoder()(text, packing.END_ID).tolist() == whole_ids(text), text


def test_word_ids_of_latin_words_with_full_tables(monkeypatch):
    from strata.llm import word_ids

    monkeypatch.setattr(word_ids, "KEPT", 50)
    encode = word_ids.Encoder(public_tokenizers.path(packing.MODEL))
    rng = random.Random(7)
    latin = [chr(c) for c in range(33, 0x250)]
    for _ in range(6000):
        text = " ".join("".join(rng.choices(latin, k=rng.randrange(1, 6))) + rng.choice(["", ",", ".;", "7"]) for _ in range(4))
        assert encode(text, packing.END_ID).tolist() == whole_ids(text), text


@pytest.mark.parametrize("parts", [1, 7])
def test_packing(odd, plain, parts):
    found = packing.pack(odd.repartition(parts), keep_ids=True).collect()
    expected = Counter((d, tuple(whole_ids(t))) for d, t, *_ in plain)
    assert_packed(found, expected)
    assert sum(1 for s in by_sequence(found).values() if not power_of_two(s)) <= 1


def by_sequence(found):
    out = defaultdict(list)
    for r in found:
        out[r.sequence_id].append(r)
    return out


def power_of_two(pieces):
    n = sum(r.length for r in pieces)
    return n & (n - 1) == 0


def assert_packed(found, expected):
    for pieces in by_sequence(found).values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    documents = defaultdict(list)
    for r in found:
        ids = np.frombuffer(r.ids, dtype="<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        documents[r.doc_id].append((r.start, r.doc_tokens, ids.tolist()))
    total = Counter()
    for (d, ids), n in expected.items():
        for piece in documents[d]:
            assert piece[1] in {len(i) for e, i in expected if e == d}
        total[d] += n * len(ids)
    for d, n in total.items():
        assert sum(len(x) for _, _, x in documents[d]) == n
        own = [ids for e, ids in expected if e == d]
        if len(own) == 1 and expected[(d, own[0])] == 1:
            assert sum((x for _, _, x in sorted(documents[d])), []) == list(own[0])


def test_packing_nothing(empty):
    assert packing.pack(empty).count() == 0


# -- fingerprints -----------------------------------------------------------------------


def plain_shingles(text):
    words = text.lower().split()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def plain_fingerprint(text):
    """The documented hash of a shingle in whole numbers; all of a short text, else those below an eighth."""
    m = (1 << 64) - 1
    found = set()
    for words in plain_shingles(text):
        h = 0
        for w in words:
            h = (h * 0x9E3779B97F4A7C15 + xxhash.xxh3_64_intdigest(w)) & m
        h = ((h ^ (h >> 31)) * 0xBF58476D1CE4E5B9) & m
        found.add(h ^ (h >> 29))
    short = len(found) <= 64
    return ("all:" if short else "") + "".join(f"{h:016x}" for h in sorted(found) if short or h < (1 << 64) // 8)


@pytest.mark.parametrize("n_words", [1, 4, 5, 6, 8, 12, 16, 20, 30, 60])
def test_short_texts_are_found_in_long_ones(n_words):
    rng = random.Random(n_words)
    words = [f"w{rng.random()}" for _ in range(3000)]
    long_ = np.unique(fingerprints.shingle_hashes(" ".join(words)))
    for at in range(0, 2900, 290):
        part = words[at : at + n_words]
        own = np.unique(fingerprints.shingle_hashes(" ".join(part)))
        # A text of less than five words is one shingle of its own length, which no longer text has.
        assert fingerprints.likeness(own, long_) == fingerprints.likeness(long_, own) == float(n_words >= 5)


def test_edited_fingerprints(odd, plain, empty):
    table = sorted(plain, key=lambda r: (r[0] is None, -(r[0] or 0)))
    found = {r.doc_id: r for r in fingerprints.edited_fingerprints(odd).collect()}
    assert fingerprints.edited_fingerprints(odd).count() == len(plain)
    for (d, t, *_), (_, following, *_) in zip(table, table[1:]):
        if d in (None, 0, 310):  # two without an id, and two of one id, stand in hash order
            continue
        t, following = t or "", following or ""
        half = len(t) // 2
        text = t[: len(t) - half] + following[:half]
        r = found[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(text.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (plain_fingerprint(t), plain_fingerprint(text))
        for near, other in ((r.near_edited, text), (r.near_next, following)):
            x, y = plain_shingles(t), plain_shingles(other)
            true = float(len(x) == len(y)) if not x or not y else len(x & y) / min(len(x), len(y))
            assert near == true if min(len(x), len(y)) <= 64 else abs(near - true) < 0.35
    assert fingerprints.edited_fingerprints(empty).count() == 0


def test_last_document_is_followed_by_the_first(llm):
    table = [(i, f"text number {i} of them all") for i in range(50)]
    frame = llm.createDataFrame(table, "doc_id long, text string").repartition(4)
    for ranges in (1, 7):
        found = {r.doc_id: r.edited_sha256 for r in fingerprints.edited_fingerprints(frame, ranges=ranges).collect()}
        for i, text in table:
            new = fingerprints.edited(text, table[i - 1][1])
            assert found[i] == hashlib.sha256(new.encode()).hexdigest()


def test_sketches_estimate_and_merge():
    rng = random.Random(9)
    words = [f"w{rng.random()}" for _ in range(20_000)]
    a, b = " ".join(words[:15_000]), " ".join(words[9_000:10_000])
    assert abs(fingerprints.containment(fingerprints.sketch(a), fingerprints.sketch(b)) - 1) < 0.05
    c = " ".join(words[14_500:15_500])
    assert abs(fingerprints.containment(fingerprints.sketch(a), fingerprints.sketch(c)) - 0.5) < 0.15
    both = fingerprints.merged(fingerprints.sketch(a), fingerprints.sketch(c))
    assert set(both.hashes) == set(fingerprints.sketch(a).hashes) | set(fingerprints.sketch(c).hashes)
    short, other = fingerprints.sketch("a b c d e f"), fingerprints.sketch("x y z u v w")
    assert fingerprints.merged(short, other).scale == 1 and len(fingerprints.merged(short, other).hashes) == 4
    # Short and long together stand at the lower threshold.
    mixed = fingerprints.merged(short, fingerprints.sketch(a))
    assert mixed.scale == fingerprints.SCALE and all(h < (1 << 64) // fingerprints.SCALE for h in mixed.hashes.tolist())


# -- license scans ---------------------------------------------------------------------


def plain_phrases(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = [
        (i, t.label)
        for t in license_scan.PHRASES
        for i in range(len(words))
        if words[i : i + len(t.text.split())] == t.text.split()
    ]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_license_phrases(odd, plain, empty):
    found = license_scan.scan(odd).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    same(rows(found, "*"), [(d, *plain_phrases(t)) for d, t, *_ in plain])
    assert license_scan.scan(empty).count() == 0


def test_license_phrases_over_a_table(llm):
    table = llm.read.parquet(f"{SF}/documents.parquet")
    found = license_scan.scan(table).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    same(rows(found, "*"), [(r.doc_id, *plain_phrases(r.text)) for r in table.collect()])


def test_license_notices_with_changes(llm):
    notice = license_scan.NOTICES[3].text
    changed = notice.replace("of charge, ", "of any charge, ").replace("obtaining", "getting")
    texts = [notice, f"before {changed} after", "Permission is hereby granted", "Licensed under the Apache License, Version 2.0!"]
    frame = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(frame).collect()}
    assert found[0] == ("mit", 1.0)
    assert found[1][0] == "mit" and 0.6 <= found[1][1] < 1
    assert found[2] == ("", 0.0) and found[3] == ("apache-2.0", 1.0)


def test_license_scan_is_linear_in_the_text(llm):
    def seconds(n):
        frame = llm.createDataFrame([(1, " ".join(f"w{i % 997}" for i in range(n)))], "doc_id long, text string")
        best = 1e9
        for _ in range(2):
            start = time.perf_counter()
            license_scan.matches(frame, license_scan.PHRASES + license_scan.NOTICES, license_scan.Voting()).count()
            best = min(best, time.perf_counter() - start)
        return best

    seconds(1000)
    assert seconds(160_000) < 10 * seconds(20_000)


def test_license_labels_equal_a_plain_vote(llm):
    """Notices with words left out, put in and changed, against a vote over diagonals in plain Python."""
    rng = random.Random(6)
    how, texts = license_scan.Voting(), []
    for t in license_scan.NOTICES:
        for _ in range(6):
            words = t.text.split()
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(words))
                words[at : at + rng.randrange(2)] = rng.choice([[], ["x"], ["quite", "new"]])
            texts.append(" ".join(["some", "text", *words, *rng.choice([[], ["and", "more"], words])]))

    def plain(text):
        split = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", x.lower())
        words, found, best = split(text), set(), 0.0
        for number, t in enumerate(license_scan.PHRASES + license_scan.NOTICES):
            k, own = (how.phrase_k if t.whole else how.notice_k), split(t.text)
            votes = defaultdict(set)
            for i in range(len(words) - k + 1):
                for j in range(len(own) - k + 1):
                    if words[i : i + k] == own[j : j + k]:
                        votes[i - j].add(j)
            spans, last = [], None
            for d in sorted(votes):
                if t.whole or last is None or d - last > how.drift:
                    spans.append(set())
                spans[-1] |= votes[d]
                last = d
            n = len(own) - k + 1
            covers = [len(x) / n for x in spans if (len(x) == n if t.whole else len(x) / n >= how.cover)]
            if covers:
                found.add(t.label)
                best = max(best, *covers)
        return ",".join(sorted(found)), best

    frame = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(frame).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}
    assert sum(bool(x[0]) for x in got.values()) > 20


# -- sharding ---------------------------------------------------------------------------


def test_sharding(llm, odd, plain, empty):
    found = sharding.sharded(odd).collect()
    assert len(found) == len(plain)
    same([(r.doc_id, r["size"], r.text_crc32) for r in found], [(d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in plain])
    slots, shard_of = defaultdict(list), defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        shard_of[r.digest].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shard_of.values())
    assert sharding.sharded(empty).count() == 0


def test_shards_are_balanced_and_numbered_over_cells(llm, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 5)
    rng = random.Random(8)
    frame = llm.createDataFrame([(i, "x" * rng.randrange(1, 900)) for i in range(3000)], "doc_id long, text string")
    found = sharding.sharded(frame, shards=10, fine=20).collect()
    load, slots = Counter(), defaultdict(list)
    for r in found:
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert max(load.values()) < 1.05 * min(load.values()) and len(load) == 10
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


# -- tool calls --------------------------------------------------------------------------

SCHEMAS = {"f": {"type": "object", "properties": {"x": {"type": "integer", "minimum": 1}, "y": {"type": "array", "items": {"type": "string"}}}, "required": ["x"], "additionalProperties": False}}
CALLS = "conv_id long, call_id string, pos long, tool string, arguments string, refs array<string>"


@pytest.mark.parametrize("small", [1000, 1])
def test_tool_calls(llm, small):
    calls = [
        (1, "a", 0, "f", '{"y":["é"], "x": 2.0}', None),
        (1, "b", 1, "f", '{"x":0}', ["a", "a", "zz"]),
        (1, "c", 2, "f", "[1]", ["b", "a"]),
        (1, "d", 3, "g", "{", ["d"]),
        (1, "e", 4, "f", None, ["d"]),
        (1, "e", 5, "f", None, ["a"]),
        (1, None, 6, "f", '{"x":1,"q":NaN}', None),
        (2, "a", 0, "f", '{"x":1,"q":1,"y":[1]}', ["b"]),
        (None, "a", 0, "f", '{"x":1}', None),
    ]
    results = [(1, "a", 1, "A"), (1, "a", 2, "B"), (1, "z", 3, "Z"), (1, None, 4, "N"), (None, "a", 1, "0")]
    found = tool_calls.link(
        llm.createDataFrame(calls, CALLS), llm.createDataFrame(results, "conv_id long, call_id string, pos long, content string"), SCHEMAS, small
    )
    got = {(r.conv_id, r.call_id, r.pos): r for r in found.collect()}
    assert len(got) == 10
    a = got[(1, "a", 0)]
    assert a.message == '{"arguments":{"x":2,"y":["é"]},"id":"a","name":"f","result":"A"}' and a.problems == ["result repeated"]
    assert [got[(1, x, p)].level for x, p in (("a", 0), ("b", 1), ("c", 2), ("d", 3), ("e", 4))] == [0, 1, 2, None, None]
    assert got[(1, "b", 1)].problems == ["call without a result", "refers to no call: zz", "x is too small"]
    assert "arguments are not an object" in got[(1, "c", 2)].problems
    assert {"circle of references", "arguments are not JSON"} <= set(got[(1, "d", 3)].problems)
    assert "call repeated" in got[(1, "e", 4)].problems
    assert {"call without an identifier", "arguments are not JSON"} <= set(got[(1, None, 6)].problems)
    assert got[(2, "a", 0)].problems[1:] == ["refers to no call: b", "q is unknown", "y[0] is not string"]
    assert got[(None, "a", 0)].linked and got[(1, "z", None)].problems == ["result without a call"]


def test_levels_by_rounds_equal_levels_in_arrays(llm):
    rng = random.Random(7)
    calls = [(c, str(i), i, "f", "{}", [str(rng.randrange(40)) for _ in range(rng.randrange(3))]) for c in range(4) for i in range(30)]
    frame = llm.createDataFrame(calls, CALLS)
    same(rows(tool_calls.call_levels(frame, 1000), "*"), rows(tool_calls.call_levels(frame, 1), "*"))


def test_tool_call_query_covers_all_turns(llm):
    turns = llm.read.parquet(f"{SF}/conversations.parquet")
    found = queries.runners()["op4_tool_call_linking"](llm, SF).collect()
    calls = [(r.conv_id, r.turn) for r in turns.collect() if r.role != "assistant"]
    assert sorted((r.conv_id, r.pos) for r in found if r.pos is not None) == sorted(calls)
    assert all(json.loads(r.message)["id"] == r.call_id for r in found)


def test_turns_without_a_role_are_calls(llm):
    turns = llm.createDataFrame([(1, 0, None, "who says this"), (1, 1, "assistant", "yes")], "conv_id long, turn int, role string, text string")
    calls, results = queries.chat_calls(turns)
    assert [r.call_id for r in calls.collect()] == [r.call_id for r in results.collect()] == ["1:0"]


# -- segmentations -------------------------------------------------------------------------


def all_segmentations(model, word):
    def from_(place):
        if not place[2]:
            return [((), 0.0)]
        return [(ids + rest, math.log(p) + q) for next_, ids, p, _ in place[2] for rest, q in from_(next_)]

    return dict(from_(model.word(word)))


def test_samples_are_without_replacement_and_of_the_right_chance():
    model = segmentation.Lattice(segmentation.MODEL, 0.5)
    chance = {s: math.exp(m) for s, m in all_segmentations(model, "▁tion").items()}
    assert abs(sum(chance.values()) - 1) < 1e-9
    n, first, second = 6000, Counter(), Counter()
    for seed in range(n):
        got = model.sample("tion", 2, seed)
        assert got[0][0] != got[1][0]
        first[tuple(got[0][0])] += 1
        second[tuple(got[1][0])] += 1
    for s, p in chance.items():
        then = sum(chance[o] * p / (1 - chance[o]) for o in chance if o != s)
        assert abs(first[s] / n - p) < 0.03 and abs(second[s] / n - then) < 0.03


def test_third_samples_over_two_words_are_of_the_right_chance():
    model = segmentation.Lattice(segmentation.MODEL, 0.3)
    one, two = all_segmentations(model, "▁ab"), all_segmentations(model, "▁is")
    chance = {a + b: math.exp(p + q) for a, p in one.items() for b, q in two.items()}
    assert abs(sum(chance.values()) - 1) < 1e-9
    n, third = 6000, Counter()
    for seed in range(n):
        got = model.sample("ab is", 3, seed)
        assert len({tuple(ids) for ids, *_ in got}) == 3
        for ids, log_prob, _ in got:
            assert abs(chance[tuple(ids)] - math.exp(log_prob)) < 1e-9
        third[tuple(got[2][0])] += 1
    for s, p in chance.items():
        others = [(a, q) for a, q in chance.items() if a != s]
        then = sum(q / (1 - q) * r * p / (1 - q - r) for a, q in others for b, r in others if a != b)
        assert abs(third[s] / n - then) < 0.03


def test_all_segmentations_come_out_when_k_is_large():
    model = segmentation.lattice()
    got = model.sample("ab é", 1000, 1)
    wanted = len(all_segmentations(model, "▁ab")) * len(all_segmentations(model, "▁é"))
    assert len({tuple(x) for x, *_ in got}) == wanted and all(q == 1.0 for *_, q in got)


def test_texts_searched_together_give_what_each_gives_alone(monkeypatch):
    model, rng = segmentation.lattice(), random.Random(3)
    texts = [" ".join(str(rng.random()) for _ in range(n)) for n in (1, 9, 70)] + ["a", "is is", "一二三 😀 ﬁ K", "x" * 500]
    alone = [model.sample(text, 6, seed) for seed, text in enumerate(texts)]
    together = segmentation._search(model, [model.normalise(t) for t in texts], range(len(texts)), 6)
    assert [[(model.ids(e)[0].tolist(), mass, chance) for e, mass, chance in found] for found in together] == alone
    # Groups that begin too improbably to be searched are none of the best.
    monkeypatch.setattr(segmentation, "NEAR", math.inf)
    assert [model.sample(text, 6, seed) for seed, text in enumerate(texts)] == alone


def test_texts_fall_apart_where_no_piece_goes_on():
    model = segmentation.Lattice(segmentation.MODEL, 0.3)
    whole = all_segmentations(model, "▁is,\n\nab▁é")
    got = model.sample("is,\n\nab é", len(whole) + 1, 5)
    assert {tuple(ids) for ids, *_ in got} == set(whole) and len(got) == len(whole)
    assert all(abs(whole[tuple(ids)] - log_prob) < 1e-9 for ids, log_prob, _ in got)


def test_words_met_before_are_not_built_again(monkeypatch):
    built, make = [], segmentation._Words.__init__

    def counted(self, model, words):
        built.extend(words)
        make(self, model, words)

    monkeypatch.setattr(segmentation._Words, "__init__", counted)
    texts = ["one two three", "three, two\none.", "one é two é three", "x" * 300 + " one"]
    model = segmentation.Lattice(segmentation.MODEL, 1.0)
    held = [model.sample(text, 4, seed) for seed, text in enumerate(texts)]
    assert len(built) == len(set(built)) < 15
    # What is held is bounded, and samples do not depend on it.
    monkeypatch.setattr(segmentation, "HELD_EDGES", 1)
    model = segmentation.Lattice(segmentation.MODEL, 1.0)
    assert [model.sample(text, 4, seed) for seed, text in enumerate(texts)] == held
    assert len(built) > len(set(built)) and len(model.held) < 5


def test_segmentations_of_odd_texts(llm, odd, plain, empty):
    found = segmentation.sampled_segmentations(odd.where("n_chars < 5000"), ["doc_id"], k=2)
    again = segmentation.sampled_segmentations(odd.where("n_chars < 5000").repartition(3), ["doc_id"], k=2)
    same(rows(found, "*"), rows(again, "*"))
    texts = {json.dumps([None if d is None else str(d)], separators=(",", ":")): t for d, t, *_ in plain if d is not None}
    for r in found.where("key <> '[null]'").collect():
        assert r.decoded == texts[r.key] and 0 <= r.inclusion <= 1
    assert segmentation.sampled_segmentations(empty, ["doc_id"]).count() == 0


def test_segmentation_query_covers_documents_and_turns(llm):
    found = {r.key for r in queries.runners()["op9_sampled_segmentations"](llm, SF).select("key").distinct().collect()}
    docs = llm.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()
    turns = llm.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn").collect()
    assert found == {json.dumps([str(x) for x in r], separators=(",", ":")) for r in [*docs, *turns]}


# -- pipeline ----------------------------------------------------------------------------------


def test_pipeline(llm, plain, tmp_path):
    folder = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    table = [r for r in plain if r[0] is not None]
    llm.createDataFrame(table, schema).write.parquet(f"{folder}/documents.parquet")
    verdict = {r.doc_id: r.kept for r in quality_rules.verdicts(llm.read.parquet(f"{folder}/documents.parquet")).collect()}
    texts = {r.doc_id: r.text for r in quality_rules.kept_documents(llm.read.parquet(f"{folder}/documents.parquet")).collect()}
    assert set(texts) == {d for d, k in verdict.items() if k}
    deduped = {d: t for d, _, _, t in plain_line_dedup(sorted(texts.items()))}
    order = sorted(deduped)
    group = alike_groups([deduped[d] for d in order])
    stay = {min(d for d, h in zip(order, group) if h == g) for g in group}
    assert 1 < len(stay) < len(order)
    found = corpus_pipeline.run(llm, folder).collect()
    tokens = Counter()
    for r in found:
        tokens[r.doc_id] += r.length
    assert tokens == Counter({d: len(whole_ids(deduped[d])) for d in stay})


def test_stages_keep_the_columns(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(llm, docs, SF).schema == docs.schema


def test_stages_of_nothing(llm, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(llm, empty, SF).count() == 0


def test_the_stage_links_by_simhash(llm):
    """Fingerprints link near copies without any band, and only what its shingles confirm."""
    rng = random.Random(11)
    words = [f"w{rng.randrange(5000)}" for _ in range(900)]
    near = [words[:i] + ["edited"] + words[i + 1 :] for i in (0, 450, 899)]
    apart = [f"v{rng.randrange(5000)}" for _ in range(900)]
    texts = [" ".join(w) for w in (words, *near, apart)]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    source = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("h"))
    marked = source.mapInArrow(shingle_dedup._marked, shingle_dedup.MARKED).localCheckpoint()
    node = {r.doc_id: bytes(r.node) for r in marked.collect()}
    fp = {r.doc_id: r.fp & (2**64 - 1) for r in marked.collect()}
    assert all((fp[0] ^ fp[i]).bit_count() <= 4 for i in (1, 2, 3)) and (fp[0] ^ fp[4]).bit_count() > 4
    assert fp[4] == simhash.simhash(texts[4].encode(), 5)
    no_bands = marked.withColumn("keys", F.array().cast("array<long>"))
    roots = {bytes(r.node): bytes(r.root) for r in shingle_dedup.linked_roots(docs, no_bands).collect()}
    assert set(roots) == {node[i] for i in range(4)} and len(set(roots.values())) == 1
    close = llm.createDataFrame([(bytearray(b"x"), 7), (bytearray(b"y"), 7), (bytearray(b"z"), 15)], "node binary, fp long")
    pairs = {(bytes(r.a), bytes(r.b)) for r in shingle_dedup.simhash_pairs(close).collect()}
    assert pairs == {(b"x", b"y"), (b"x", b"z")}
