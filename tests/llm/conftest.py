import random

import pytest

EXTRA = "id string, rk int, n int, chunk string, host string, `quality stats` string, component_id string, words string, bucket int, hash int"


def prose(seed: int, n: int, vocabulary: int = 4000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary):x}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(id, text): nulls, empties, a very long text, near and exact copies, shared passages, repeated rows, ties."""
    base, passage = prose(1, 200), prose(2, 60)
    words = base.split(" ")
    near = " ".join([*words[:100], "changed", *words[101:]])
    far = " ".join([*words[:100], *prose(3, 100).split(" ")])
    long = "\n".join(prose(100 + i, 50) for i in range(400))
    return [
        (0, base), (1, base), (2, near), (3, far), (4, None), (5, ""), (6, " \t\n "), (7, "one"), (8, "One two"), (9, "one TWO"),
        (10, prose(4, 80) + "\n" + passage + " " + prose(5, 80)), (11, passage + ". " + prose(6, 90)), (12, long), (13, long + " tail"),
        (14, prose(7, 35)), (15, prose(7, 35)), (16, prose(8, 34)), (17, prose(8, 34)), (18, "x" * 5000), (19, "aa bb cc " * 40),
        (20, "Ünïcode wörds ñ 日本語 テスト 😀 " * 12), (21, "dup row"), (21, "dup row"), (None, "no id here"), (None, None), (22, base.upper()),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows with further columns whose names operators use inside."""
    rows = [(i, t, "z", 1, 2, "c", "h", "q", "k", "w", 3, 4) for i, t in odd_rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, {EXTRA}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, extra string")
