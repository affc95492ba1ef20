import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use inside.
CLASHING = ("_text", "_row", "_key", "key", "token", "sid", "kept", "regions", "spans", "topic", "weight", "n_words", "host", "digest", "cell", "id", "part")


def words(rnd, n, vocabulary=4000):
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


def edge_rows():
    """Nulls in any column, empty and blank texts, a very long one, copies, near copies, repeated rows, shared passages."""
    rnd = random.Random(5)
    base, passage = words(rnd, 120), words(rnd, 60)
    texts = [None, "", " \n\t ", "one", "One two", "one two three", "A b C d", "a b c d", "éa ÉA é  \x1f x", "x " * 3000]
    texts += [" ".join(words(rnd, 30_000)), "nospace" * 4000]
    texts += [" ".join(base)] * 3 + [" ".join(base).upper()]
    for n_edits in (1, 1, 2, 2, 3, 4, 6, 9):
        near = list(base)
        for _ in range(n_edits):
            near[rnd.randrange(len(near))] = f"e{rnd.randrange(10**6)}"
        texts.append(" ".join(near))
    for _ in range(6):
        texts.append(" ".join([*words(rnd, rnd.randrange(5, 90)), *passage[: rnd.randrange(15, 60)], *words(rnd, rnd.randrange(5, 90))]))
    texts += ["mail a.b@c.example.com or +1 (269) 555-3296 at 10.0.0.1", "card 4524132264652876.", "line\nline\nline\nother\n", "a | b | c | d | e | f | g | h | i | j"]
    rows = [(i, t, rnd.choice(["en", "de", None]), rnd.choice(["src0", "src0", "src1", None]), len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[12], rows[20], (None, texts[13], "en", "src0", 1), (None, None, None, None, None), (None, "alone here with some words", "de", None, 3)]
    return rows


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def clashing(edges):
    """The same rows with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    return edges.select("*", *(F.lit("x").alias(c) for c in CLASHING))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
