"""Fill-in-middle against plain slicing, and the round trip."""

import hashlib
import random
import re

import pytest

from strata.llm import fill_middle


def plain_middle(doc_id, text, how=fill_middle.Moves()):
    h = hashlib.sha256(f"{how.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in range(0, 32, 8)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(m in text for m in fill_middle.MARKERS) or h[2] % 100 >= how.rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < how.spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def texts():
    rng = random.Random(3)
    piece = lambda: rng.choice(["", "a", "é", "一二", "😀", "\r", "word " * 30, "<", "P>", "<<S", "\x0b\x85 "])
    out = ["".join(piece() + ("\n" if rng.random() < 0.3 else "") for _ in range(rng.randrange(1, 200))) for _ in range(300)]
    return out + ["", "\n", "\n\n\n", "x", "x\n", "a<P>b\n" * 9, "<M>", "é" * 5000, "\n" * 5000, ("😀" * 341 + "\n") * 40]


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, 1024])
def test_every_cut_is_found(block):
    for text in texts()[::7]:
        units, data = re.findall(r"[^\n]*\n|[^\n]+", text), text.encode()
        blocks = fill_middle.Blocks(data, block)
        assert blocks.n_units == len(units)
        for k in range(0, len(units) + 1, 1 + len(units) // 50):
            before = "".join(units[:k])
            assert blocks.cut(k) == (len(before.encode()), len(before))


@pytest.mark.parametrize("how", [fill_middle.Moves(), fill_middle.Moves(seed=1, rate=60, spm=20)])
def test_moved_texts(how):
    for i, text in enumerate(texts()):
        *found, output = fill_middle.moved(i, text.encode(), how)
        assert (*found, output.decode()) == plain_middle(i, text, how)


def test_transform_and_restore(llm, odd, plain, empty):
    got = fill_middle.transform(odd).withColumn("again", fill_middle.restored()).collect()
    expected = [(d, *plain_middle(d, t or ""), t or "") for d, t, *_ in plain]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert fill_middle.transform(empty).count() == 0
    rows = list(enumerate(texts()))
    back = fill_middle.transform(llm.createDataFrame(rows, "doc_id long, text string")).select("doc_id", fill_middle.restored().alias("t"))
    assert sorted(map(tuple, back.collect())) == rows
