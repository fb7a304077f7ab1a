"""Suffix dedup and substring dedup against brute force."""

import random

import numpy as np
import pytest
from enrichkit.llm import anchors, substring_dedup, suffix_dedup
from enrichkit.llm.anchors import maximal_runs, word_units
from hypothesis import given, settings
from hypothesis import strategies as st


def expected(rows, plain, length, encode):
    texts = [encode(r.text) for r in rows]
    return sorted((r.doc_id is None, r.doc_id or 0, t, maximal_runs(h))
                  for r, t, h in zip(rows, texts, plain(texts, length), strict=True))


@pytest.mark.parametrize("length,k", [(40, 8), (24, 24), (35, 4)])
def test_suffix_dedup(hard, length, k):
    rows = hard.select("doc_id", "text").collect()
    want = expected(rows, suffix_dedup.plain_removed, length, lambda t: (t or "").encode())
    got = suffix_dedup.suffix_dedup(hard, length=length, k=k).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, [(s.start, s.end) for s in r.spans],
                   bytes(r.kept)) for r in got) == sorted(
        (a, b, len(t), sum(z - y for y, z in runs), runs,
         b"".join(p for p in _outside(t, runs))) for a, b, t, runs in want)


def _outside(t, runs):
    at = 0
    for a, z in runs:
        yield t[at:a]
        at = z
    yield t[at:]


@pytest.mark.parametrize("length,k", [(10, 4), (35, 8)])
def test_substring_dedup(hard, length, k):
    rows = hard.select("doc_id", "text").collect()
    hits = substring_dedup.plain_removed([r.text or "" for r in rows], length)
    want = sorted((r.doc_id is None, r.doc_id or 0, len(h), int(h.sum()), maximal_runs(h),
                   " ".join(w.decode() for w, x in zip((r.text or "").encode().split(), h, strict=True) if not x))
                  for r, h in zip(rows, hits, strict=True))
    got = substring_dedup.substring_dedup(hard, length=length, k=k).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, [(s.start, s.end) for s in r.spans], r.kept)
                  for r in got) == want


def test_full_groups_are_split(spark):
    """A hot anchor (one passage in many contexts) beyond the group bound."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(6))
    shared = [word() for _ in range(30)]
    texts = [" ".join([*[word() for _ in range(20)], *shared, *[word() for _ in range(20)]]) for _ in range(30)]
    texts += [texts[0][:150], texts[1] + " " + texts[2]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for unit, length, k, compare, plain in (
            ("words", 12, 4, substring_dedup.extend_matches(12, 4), substring_dedup.plain_removed),
            ("bytes", 64, 16, lambda a, c, p, s: suffix_dedup.repeated_starts(a, c, p, s, 64),
             lambda t, n: suffix_dedup.plain_removed([x.encode() for x in t], n))):
        keyed = anchors.keyed(df, "doc_id", "text")
        want = {i: maximal_runs(h) for i, h in enumerate(plain(texts, length)) if h.any()}
        for bound in (2, 2048):
            got = anchors.repeated_spans(keyed, unit, length, k, compare, group_rows=bound, batch_bytes=500).collect()
            sizes = {i: len(t.encode().split()) if unit == "words" else len(t.encode()) for i, t in enumerate(texts)}
            assert {r.doc_id: maximal_runs(anchors.covered([s.asDict() for s in r.spans], sizes[r.doc_id]))
                    for r in got} == want


def test_hot_anchors_are_not_counted_and_joined_in_one_exchange(spark, monkeypatch):
    """A skewed join can only be split if no aggregate by the anchor shares its exchange."""
    seen, contents = [], anchors.contents
    monkeypatch.setattr(anchors, "contents", lambda texts, wanted, *a: seen.append(wanted) or contents(texts, wanted, *a))
    docs = spark.createDataFrame([(i, f"head {i} " + "a b c d e f g h " * 3 + f"tail {i}") for i in range(20)],
                                 "doc_id long, text string")
    assert suffix_dedup.suffix_dedup(docs, length=20, k=8).filter("n_removed > 0").count() == 20
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Aggregate" not in plan


def test_passages_of_many_words_below_the_byte_length_stay(spark):
    """Planted passages: cut where they have 400 bytes, whole where 60 short words have fewer; n_bytes
    is the length of the text either way."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    long, short = " ".join(word(8) for _ in range(60)), " ".join(word(4) for _ in range(60))
    texts = {i: f"{word(30)} {p} {word(50)}" for i, p in enumerate([long, long, short, short, word(500), word(900)])}
    got = suffix_dedup.suffix_dedup(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), length=400).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed) for r in got} == {
        i: (len(t), len(long) + 2 if i < 2 else 0) for i, t in texts.items()}


def test_empty_tables(nothing):
    assert suffix_dedup.suffix_dedup(nothing).count() == 0
    assert substring_dedup.substring_dedup(nothing).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=14), min_size=1, max_size=9))
def test_column_wise_construction(docs):
    symbol, after, rounds, suffix = [], [], [], []
    for d in docs:
        for i in range(len(d)):
            after.append(len(symbol) + 1 if i + 1 < len(d) else -1)
            rounds.append(len(d) - 1 - i)
            suffix.append(tuple(d[i:]))
            symbol.append(d[i])
    names, lcp = suffix_dedup.collection_bwt(np.array(symbol), np.array(after), np.array(rounds), 50)
    order = [suffix[i] for i in names]
    assert order == sorted(suffix)
    for a, b, n in zip(order, order[1:], lcp[1:], strict=False):
        same = 0
        while same < min(len(a), len(b)) and a[same] == b[same]:
            same += 1
        assert same == n


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60000), min_size=1, max_size=400), st.data())
def test_range_minima(values, data):
    v = np.array(values, np.uint16)
    lo = data.draw(st.integers(0, len(v) - 1))
    hi = data.draw(st.integers(lo, len(v) - 1))
    assert suffix_dedup.range_minima(v, np.array([lo]), np.array([hi]))[0] == v[lo:hi + 1].min()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=80), st.integers(1, 6), st.integers(0, 6))
def test_equal_passages_have_equal_anchors(units, k, more):
    u, length = np.array(units, np.uint8), k + more
    start, n, anchor = anchors.segments(u, length, k)
    assert n.sum() == max(len(u) - length + 1, 0)
    of = {}
    for s, c, a in zip(start, n, anchor, strict=True):
        for i in range(s, s + c):
            assert of.setdefault(u[i:i + length].tobytes(), a) == a


def test_word_units_tell_words_apart():
    a = word_units(b" ab  abc\tab\nba \x0bab")
    assert len(a) == 5 and a[0] == a[2] == a[4] and len(set(a.tolist())) == 3
    assert len(word_units(b" \n ")) == 0 and len(word_units(b"")) == 0
