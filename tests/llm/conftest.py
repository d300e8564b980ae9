import random

import pytest

from paneltide.llm import store

# extra columns whose names the operators use inside
CLASH = ("id", "row", "p", "host", "size", "label", "part", "shard", "base", "all", "bucket", "tie", "copies", "gram")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in CLASH)


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    store.ship(spark)


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    parts = "an be ci do en fu ga he il ju ko la me no op".split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(words))


def edge_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows."""
    base, long = prose(1, 120), prose(2, 9000)
    near = base.split()
    near[60] = "changed"
    passage = prose(9, 70)
    texts = [
        (0, base, "en", "a"), (1, None, "en", "a"), (2, "", None, "b"), (3, long, "en", "b"), (4, base, "de", None), (5, " ".join(near), "en", "a"),
        (6, "short", "en", "c"), (6, "short", "en", "c"), (6, "short", "en", "c"), (7, "  two\twords\n", "en", "c"),
        (8, prose(3, 40) + " " + passage + " " + prose(4, 30), "en", "b"), (9, prose(5, 10) + " " + passage, "en", "a"),
        (None, prose(6, 50), None, None), (None, None, None, None), (-3, "A b C d E", "en", "a"), (10, "a" * 700, "en", "a"),
        (11, "été ÄÖ 漢字 \U0001f600 token = 'AbCdEf123456' x", "fr", "c"), (12, base, "en", "a"), (12, prose(7, 30), "en", "a"),
    ]
    return [(*t, None if t[1] is None else len(t[1]), *([1] * len(CLASH))) for t in texts]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
