import random

import pytest

from strata.llm.common import shipped

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use for columns of their own.
CLASHING = "row string, t string, doc int, h int, k1 int, part int, fp int, kept int, n_words string"


@pytest.fixture(scope="session")
def llm(spark):
    return shipped(spark)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def corpus():
    """Small documents with every odd case: NULLs, empty and long texts, ties, copies."""
    rng = random.Random(5)
    shared = "This line of more than forty code points is shared."
    long_line = prose(rng, 60)
    rows = [(i, "\n".join(prose(rng, rng.randrange(3, 40)) for _ in range(rng.randrange(1, 8))), "src%d" % (i % 3)) for i in range(60)]
    rows += [(100 + i, f"{prose(rng, 60)}\n{shared.upper() if i % 2 else shared}  \n{prose(rng, 30)}", "src0") for i in range(30)]
    base = prose(rng, 300)
    rows += [(200 + i, base, "src1") for i in range(8)]
    rows += [(220 + i, base + f" tail{i}", "src1") for i in range(8)]
    rows += [(300, None, None), (301, "", "src0"), (302, " \n\t ", None), (None, prose(rng, 80), "src2"), (None, None, None)]
    rows += [(310, "Été " * 50, "src0"), (310, "Été " * 50, "src0"), (311, "a", "src0"), (312, "x" * 30_000, "src0")]
    rows += [(313, prose(rng, 20_000), "src2"), (314, "\n".join([long_line] * 5), "src2"), (315, "一二三 😀 ﬁ K <|endoftext|> <s>", "src1")]
    rows += [(316, "Licensed under CC BY-NC 4.0. All rights reserved.\nGeneral Public License cc by cc by", "src1")]
    return [(d, t, "en", s, len(t or "")) for d, t, s in rows]


@pytest.fixture(scope="session")
def plain():
    return corpus()


@pytest.fixture(scope="session")
def docs(llm, plain, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    llm.createDataFrame(plain, COLUMNS).repartition(5).write.parquet(path)
    return llm.read.parquet(path)


@pytest.fixture(scope="session")
def odd(docs):
    """The documents with extra columns that clash."""
    out = docs
    for c in CLASHING.split(", "):
        name, kind = c.split()
        out = out.selectExpr("*", f"cast(7 as {kind}) as {name}")
    return out


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
