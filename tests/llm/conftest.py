import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Texts with nulls, blanks, repeats, ties, a long one, near copies and shared passages."""
    import random

    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, base = prose(60), prose(120)
    rows = [(0, None), (1, ""), (2, "  \n\t "), (3, "one"), (4, "one"), (5, "One two three"), (6, base), (7, base), (8, base + " end"), (9, "start " + base.upper()), (10, prose(5000))]
    rows += [(11 + i, prose(rng.randint(30, 90)) + " " + passage + " " + prose(30)) for i in range(12)]
    rows += [(30, prose(25)), (31, prose(25) + "\n" + base), (6, base), (40, "Ünï cödé — 東京 " * 12), (41, passage[:200]), (None, base), (50, "x " * 300)]
    schema = "doc_id long, text string, lang string, n_words int, kept string, score string"
    return spark.createDataFrame([(i, t, "en", 1, "mine", "mine") for i, t in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)
