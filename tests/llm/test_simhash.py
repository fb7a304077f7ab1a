import random

import numpy as np
import pytest
import xxhash
from enrichkit.llm import simhash


def plain_fingerprint(text, n=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, ids, radius):
    n, root = len(fps), list(range(len(fps)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i in range(n):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i in range(n):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i)) for i in range(n)]


def test_matches_brute_force(hard):
    rows = hard.select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    comp = plain_components(fps, [r.doc_id for r in rows], 3)
    got = simhash.simhash_near_dedup(hard).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == sorted(
        (str(r.doc_id), f"{f:016x}", c) for r, f, c in zip(rows, fps, comp, strict=True))


@pytest.mark.parametrize("radius,bucket", [(3, 2048), (3, 48), (1, 2048), (5, 64), (0, 10)])
def test_links_are_complete(spark, radius, bucket):
    rng = random.Random(radius)
    centres = [rng.getrandbits(64) & ~0xFFFF for _ in range(30)]  # sixteen bits equal in all: full buckets
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, radius + 2)))
           for c in centres for _ in range(12)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.link_fingerprints(df, radius, bucket_rows=bucket).collect()
    want = plain_components(fps, list(range(len(fps))), radius)
    at = {f: i for i, f in enumerate(signed)}
    root = list(range(len(fps)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for e in edges:
        assert ((e.a ^ e.b) & (1 << 64) - 1).bit_count() <= radius
        x, y = find(at[e.a]), find(at[e.b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(fps))] == want


def test_thresholds_follow_the_generalised_principle():
    cost, ts = simhash.allocate([{-1: 0, 0: 5, 1: 50}, {-1: 0, 0: 1, 1: 2}, {-1: 0, 0: 100, 1: 200}], 0)
    assert sum(ts) == 0 and ts == [0, 1, -1] and cost == 7


def test_correlated_bits_share_a_part():
    corr = np.eye(64)
    for a, b in ((0, 40), (3, 50), (7, 20)):
        corr[a, b] = corr[b, a] = 0.9
    parts = simhash.group_bits(corr, list(range(64)), 4)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert all(any({a, b} <= set(p) for p in parts) for a, b in ((0, 40), (3, 50), (7, 20)))


def test_empty_table(nothing):
    assert simhash.simhash_near_dedup(nothing).count() == 0
