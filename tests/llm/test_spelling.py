"""Spelling variants against a plain comparison of all pairs."""
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from enrichkit.llm import spelling


def plain_words(rows, modulus=97):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % modulus == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1:]
            out[run] += 1
    return out


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows, min_length=5, min_count=3, modulus=97):
    n = {w: c for w, c in plain_words(rows, modulus).items() if len(w) >= min_length and c >= min_count}
    close = {w: [x for x in n if abs(len(x) - len(w)) < 2 and near(w, x)] for w in n}
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(close[w]), n.get(form[w])))
    return sorted(out)


def corpus(seed=4):
    rng = random.Random(seed)
    letters = "abehinorstéüß"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(60)] + ["aaaaa", "aaaaaa", "Ábcde"]
    rows = []
    for i in range(400):
        words = []
        for _ in range(rng.randint(0, 40)):
            w = rng.choice(base[:6] if rng.random() < .5 else base)
            if rng.random() < .3:
                p = rng.randrange(len(w))
                w = rng.choice([w[:p] + rng.choice(letters) + w[p:], w[:p] + w[p + 1:], w[:p] + rng.choice(letters) + w[p + 1:]])
            words.append(w.upper() if rng.random() < .1 else w)
        rows.append((i if rng.random() < .9 else rng.choice([None, 7]), rng.choice([" ", "-", "1", "÷.", "\n"]).join(words)))
    long_ = "x" * 5000
    rows += [(1, None), (2, ""), (None, None), (3, "Ÿþ ÷××÷× ÷××÷÷"), *[(9, f"{long_} {long_}y {long_[:-1]}z")] * 4,
             *[(10, "same text twice Hello hello HELLO hallo")] * 9]
    return rows


@pytest.mark.parametrize("groups,letters", [(5, 1 << 18), (2, 300), (1, 1 << 18)])
def test_equals_all_pairs(spark, groups, letters):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "a", "b") for r in rows], "doc_id long, text string, n long, word string, key string")
    got = spelling.spelling_variants(df.repartition(4), groups=groups, block_letters=letters).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[0]) == plain(rows)


def test_deleted_code_points(spark):
    rows = [(i, "Wörterbuch wort " * 3) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(spelling.words(df, modulus=3).groupBy("word").count().collect())
    assert got == dict(plain_words(rows, 3)) and len(got) > 2


def test_empty_table(spark, nothing):
    assert spelling.spelling_variants(nothing).count() == 0


def test_gram_distances_are_exact():
    rng = np.random.default_rng(0)
    some = ["".join(rng.choice(list("abcé"), rng.integers(5, 8))) for _ in range(200)]
    codes = spelling._codes(some, 9)
    x = spelling._counts(codes)
    i, j = spelling.close_pairs(x[:90], x)
    want = {(a, b) for a in range(90) for b in range(200)
            if sum((some[a].count(c) - some[b].count(c)) ** 2 for c in "abcé") <= 2}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want


def test_hot_block_is_dealt_into_parts(spark):
    """Anagrams all lie in one block: it is cut into parts of bounded size, and
    no pair is lost between them."""
    rng = random.Random(2)
    words = {"".join(rng.sample("abcdefgh", 8)) for _ in range(600)} | {"".join(rng.choice("ab") for _ in range(8)) for _ in range(300)}
    rows = [(i, " ".join([w] * 3)) for i, w in enumerate(sorted(words))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    vocab = spelling.vocabulary(df, modulus=10**9)
    placed = spelling.blocks(vocab, spelling.letter_groups(vocab, 2), 4000)
    most = placed.filter("guest = 0").groupBy("key", "part").count().agg(F.max("count")).first()[0]
    assert most < 150
    got = spelling.spelling_variants(df, modulus=10**9, groups=2, block_letters=4000).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[0]) == plain(rows, modulus=10**9)
