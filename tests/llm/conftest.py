import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid string, n string, __text string, spans string"


@pytest.fixture(scope="session")
def passage():
    rnd = random.Random(5)
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(70))


@pytest.fixture(scope="session")
def rows(passage):
    """Odd documents: nulls, empties, repeated rows and ids, ties, long texts, and columns
    whose names clash with those used inside."""
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    base = text(120)
    near = base.split(" ")
    near[60] = "changed"
    line = "A Common Line that is long enough to count as one"
    out = [
        (1, passage), (2, text(30) + " " + passage + " " + text(10)), (3, None), (4, ""), (5, " \t\n "), (6, base), (7, " ".join(near)), (7, text(40)), (8, base), (8, base),
        (None, passage), (None, None), (9, "a b"), (10, "a b"), (11, "éß 日本 " * 40), (12, "x" * 5000), (13, "loop " * 400), (14, passage + "\n" + passage), (15, text(4000)), (16, "\x00 null byte " + passage[:100]),
    ] + [(20 + i, f"{text(25)}\n  {line if i % 2 else line.upper()} \n{text(25)}\n\n") for i in range(7)]
    return [(i, t, ["en", None, "fr"][k % 3], None if k % 4 == 0 else "s", k, "clash", None, "clash", "x") for k, (i, t) in enumerate(out)]


@pytest.fixture(scope="session")
def odd(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
