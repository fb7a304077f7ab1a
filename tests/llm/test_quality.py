import random

import numpy as np
import pytest
from enrichkit.llm import quality
from hypothesis import given, settings
from hypothesis import strategies as st


def plain_marginals(em, trans):
    """Sum over all label sequences of one text."""
    n = len(em)
    p, z = np.zeros(n), 0.0
    for code in range(2 ** n):
        y = [code >> i & 1 for i in range(n)]
        s = np.exp(sum(e for e, v in zip(em, y, strict=True) if v)
                   + sum(trans[a][b] for a, b in zip(y, y[1:], strict=False)))
        z += s
        p += s * np.array(y)
    return p / z


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.floats(-3, 3), min_size=1, max_size=6), min_size=1, max_size=5),
       st.lists(st.floats(-2, 2), min_size=4, max_size=4))
def test_forward_backward_is_exact(texts, t):
    trans = np.array(t).reshape(2, 2)
    p, pair = quality.forward_backward(np.concatenate([np.array(x) for x in texts]),
                                       np.array([len(x) for x in texts]), trans)
    want = np.concatenate([plain_marginals(x, trans) for x in texts])
    assert np.allclose(p, want)
    assert pair.sum() == pytest.approx(sum(len(x) - 1 for x in texts))


def test_line_features_are_a_texts_own():
    texts = [b"Hello there you.\nAB!! CD!! | x", b"", b"word word word\n\n", "Ünï ÉÉ 12".encode(), b"\n", b"end"]
    x, length, lines = quality.line_features(texts)
    assert lines.tolist() == [2, 0, 2, 1, 1, 1] and len(x) == lines.sum()
    at = 0
    for t, n in zip(texts, lines, strict=True):
        own, own_len, _ = quality.line_features([t])
        assert np.allclose(own, x[at:at + n]) and np.allclose(own_len, length[at:at + n])
        at += n


def make(spark, n=400):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    good = lambda: " ".join(word() for _ in range(rng.randint(6, 14))).capitalize() + "."
    bad = lambda: rng.choice([lambda: " ".join([word()] * 12), lambda: " ".join(word().upper() + "!!" for _ in range(8)),
                              lambda: " ".join(word() + rng.choice(["***", "%%%"]) for _ in range(9))])()
    docs, labels = [], []
    for i in range(n):
        y = int(rng.random() < 0.6)
        lines = [good() if y or rng.random() < 0.2 else bad() for _ in range(rng.randint(1, 6))]
        if not y and all(x.endswith(".") for x in lines):
            lines.append(bad() + " " + bad())
        docs.append((i, "\n".join(lines)))
        labels.append((i, y))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame([*labels, (None, 1), (3, None), (10 ** 9, 1)], "doc_id long, quality int"))


def test_held_out_accuracy(spark):
    docs, labels = make(spark)
    got = quality.score_quality(docs, quality.train(docs, labels, sample=100))
    rows = got.join(labels.filter("quality is not null"), "doc_id").filter("held_out").collect()
    assert len(rows) > 50 and np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_held_out_labels_teach_nothing(spark):
    docs, labels = make(spark, 200)
    turned = labels.withColumn("quality", __import__("pyspark").sql.functions.when(
        quality.held_out(labels.doc_id), 1 - labels.quality).otherwise(labels.quality))
    a, b = quality.train(docs, labels, sample=100), quality.train(docs, turned, sample=100)
    assert np.allclose(a["w"], b["w"]) and a["a"] == b["a"]


def test_hard_rows(spark, hard, nothing):
    docs, labels = make(spark, 200)
    model = quality.train(docs, labels)
    rows = quality.score_quality(hard, model).collect()
    assert len(rows) == hard.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    kept = quality.keep_good(hard, model)
    assert kept.columns == hard.columns
    assert kept.count() == sum(r.predicted for r in rows)
    none = quality.train(docs, labels.limit(0))
    assert none == {} and {r.score for r in quality.score_quality(hard, none).collect()} == {0.0, 0.5}
    assert quality.score_quality(nothing, model).count() == 0 and quality.keep_good(nothing, model).count() == 0
    assert quality.train(nothing, labels) == {}


def test_sample_bound_leaves_scores(spark):
    """A bound that evens out a 6:1 class ratio must not move the scores: texts
    between the classes would fall below the threshold on large tables only."""
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(2, 9)))
    docs, labels = [], []
    for i in range(1400):
        y = int(rng.random() < 6 / 7)
        mark = lambda: "!!" if rng.random() < (0.25 if y else 0.5) else ""  # noqa: E731, B023
        docs.append((i, "\n".join(" ".join(word() + mark() for _ in range(8)) for _ in range(2))))
        labels.append((i, y))
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    score = lambda sample: np.array([r.score for r in quality.score_quality(
        docs, quality.train(docs, labels, sample=sample)).orderBy("doc_id").collect()])
    whole, bounded = score(3000), score(120)
    assert abs(whole.mean() - bounded.mean()) < 0.05
    assert abs((whole >= 0.7).mean() - (bounded >= 0.7).mean()) < 0.08


def test_one_class_rejects_nothing(spark, hard):
    docs, labels = make(spark, 60)
    for y in (0, 1):
        model = quality.train(docs, labels.filter(f"quality = {y}"))
        assert model == {} and quality.keep_good(docs, model).count() == 60
        kept = quality.keep_good(hard, model)
        assert kept.columns == hard.columns and kept.count() == hard.count()


def test_sample_is_bounded_in_lines(spark):
    """Long documents that would pass the bound are left out of the sample, the
    others fit the model; the driver never holds more lines."""
    rng = np.random.default_rng(5)
    words = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(n))
    rows = [(i, "\n".join(words(8) + "." if i % 2 else "|| 77 $$ 99 ==" for _ in range(4))) for i in range(400)]
    rows += [(i, "\n" * 50_000) for i in range(400, 404)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(404)], "doc_id long, quality int")
    model = quality.train(docs, labels, sample=3000, sample_lines=700)
    got = {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()}
    assert all((got[i] > 0.7) == bool(i % 2) for i in range(400))
    assert quality.train(docs, labels, sample_lines=3) == {}
