"""Fixtures of hard inputs for the training-data operators."""

import random

import pytest

CLASH = "doc_id long, text string, lang string, source string, n_chars long, th long, anchor string, fp string, " \
        "label string, size string, ids string, spans string, score string, copies string, name string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))


def hard_rows(seed=7):
    """Nulls in every column, empty and long texts, ties, repeated rows, one id
    with two texts, copies, near copies, shared passages."""
    rng = random.Random(seed)
    shared = prose(rng, 60)
    base = [prose(rng, rng.randint(3, 160)) for _ in range(14)]
    near = prose(rng, 400)
    words = near.split()
    words[200] = "changed"
    texts = [*base, base[0], base[0], base[1],                       # exact copies
             near, " ".join(words), near + " tail",                  # near copies
             base[2] + " " + shared + " " + base[3], shared + "\n" + base[4], "x " + shared,
             "", "", None, None, "   \t\n ", "\n", "one", "two words",
             "word " * 3000, "Ünïcödé " * 90 + "é", prose(rng, 4000)]
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"s{i % 3}", None if i % 4 == 0 else i)
            for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], rows[20]]                             # rows repeated whole
    rows += [(5, "another text with the id five", "en", "s0", 1)]    # one id, two texts
    rows += [(None, base[6], None, None, None), (None, base[6], None, None, None), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def hard(spark):
    rows = [(*r, 1, "a", "b", "c", "d", "e", "f", "g", "h", "i") for r in hard_rows()]
    return spark.createDataFrame(rows, CLASH).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], CLASH)
