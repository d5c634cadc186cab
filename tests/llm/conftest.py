import random

import pytest

WORDS = ["".join(random.Random(i).choice(("an", "ter", "lo", "mi", "é", "ra", "von")) for _ in range(1 + i % 4)) for i in range(300)]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + ("." if r.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids and texts, empty texts, ties, repeated rows, ids used twice, clashing extra columns, a very long text."""
    base = prose(1, 120)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base + " tail of another text", "de", None), (4, None, None, "b"), (5, "", "en", "b"), (None, base, "en", "a"), (None, None, None, None),
        (6, prose(6, 80), "fr", "c"), (6, prose(7, 80), "fr", "c"), (1, base, "en", "a"), (7, "x" * 70_000 + " " + prose(8, 3000), "en", "a"), (8, "\t\n \r", "en", "a"), (9, "Ünïcödé 中文 😀 +1 (555) 555-5555", "en", "a"), (-5, prose(9, 60), "en", "a"),
    ]
    rows = [(i, t, la, s, len(t or ""), "clash", 0, "clash") for i, t, la, s in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, row int, kind string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
