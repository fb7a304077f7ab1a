import numpy as np
import pytest
from enrichkit.llm import nn_descent
from enrichkit.llm.nn_descent import embedding_near_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, vec string, v string, sim string"


def plain(rows, threshold):
    n = len(rows)
    ok = [r[1] is not None and len(r[1]) > 0 and all(x is not None and np.isfinite(x) for x in r[1])
          and any(x != 0 for x in r[1]) for r in rows]
    unit = [np.array(r[1], float) / np.linalg.norm(np.array(r[1], np.float32).astype(float)) if o else None
            for r, o in zip(rows, ok, strict=True)]
    root, deg = list(range(n)), [0] * n

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                deg[i] += 1
                deg[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return [(r[0], d, least.get(find(i)) if ok[i] else r[0]) for i, (r, d) in enumerate(zip(rows, deg, strict=True))]


def make():
    rng = np.random.default_rng(2)
    rows, i = [], 0
    for size in (1,) * 60 + (2,) * 15 + (5, 40):
        centre = rng.standard_normal(16)
        for _ in range(size):
            rows.append((i, (centre + 0.05 * rng.standard_normal(16)).astype(np.float32).tolist()))
            i += 1
    rows += [(i, rows[0][1]), (i + 1, rows[0][1]), (i + 2, None), (i + 3, []), (i + 4, [0.0] * 16),
             (i + 5, [float("nan")] + [1.0] * 15), (i + 6, [float("inf")] * 16), (i + 7, [None, *[1.0] * 15]),
             (i + 8, [1.0, 2.0]), (i + 9, [2.0, 4.0]), (None, rows[3][1]), (None, None), rows[5], rows[5]]
    return rows


def test_matches_brute_force(spark):
    rows = make()
    df = spark.createDataFrame([(*r, 0, "a", "b", "c") for r in rows], SCHEMA).repartition(3)
    got = embedding_near_dedup(df, k=6, trees=2, rounds=3).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id) for r in got) == sorted(
        (str(a), b, c) for a, b, c in plain(rows, 0.9))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert {r.audited_recall for r in got} == {1.0}


def test_empty_and_single(spark):
    assert embedding_near_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    one = embedding_near_dedup(spark.createDataFrame([(4, [1.0, 0.0], 0, "", "", "")], SCHEMA)).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in one] == [(4, 0, 4, True)]


def near(rng, centre, noise, n):
    d = len(centre)
    return [(centre + noise * rng.standard_normal(d) / np.sqrt(d)).astype(np.float32).tolist() for _ in range(n)]


def turned(rng, centre, cos):
    """A unit vector at the cosine from a unit vector."""
    other = rng.standard_normal(len(centre))
    other -= (other @ centre) * centre
    return cos * centre + np.sqrt(1 - cos ** 2) * other / np.linalg.norm(other)


def test_links_between_dense_groups(spark):
    """Lists full of their own group are enlarged until they see the other one."""
    rng = np.random.default_rng(8)
    vecs = [v.tolist() for v in rng.standard_normal((600, 16)).astype(np.float32)]
    for _ in range(8):
        a = rng.standard_normal(16)
        a /= np.linalg.norm(a)
        vecs += near(rng, a, 0.08, 20) + near(rng, turned(rng, a, 0.92), 0.08, 20)
    rows = list(enumerate(vecs))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = embedding_near_dedup(df, k=6, trees=1, rounds=2, recall_target=0.0).collect()
    want = plain(rows, 0.9)
    assert len({c for _, _, c in want[600:]}) == 8
    assert sorted((r.vec_id, r.component_id) for r in got if r.vec_id >= 600) == [(a, c) for a, _, c in want[600:]]
    assert sorted((r.vec_id, r.n_links) for r in got if r.vec_id >= 600) == [(a, b) for a, b, _ in want[600:]]


def planted(rng, n, pairs, group, dim=24):
    """Random vectors, some with one partner at cosine 0.93, and one dense group."""
    x = rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    vecs = [*x, *(turned(rng, x[i], 0.93) for i in range(pairs))]
    return [np.asarray(v, np.float32).tolist() for v in vecs] + near(rng, x[-1], 0.1, group)


def test_audit_sees_lost_sparse_links(spark):
    """No link of a pair is found, all of a dense group are: recall is 0, not near 1."""
    rng = np.random.default_rng(4)
    vecs = planted(rng, 200, 20, 80)
    df = spark.createDataFrame(list(enumerate(vecs)), "vec_id long, vec array<float>")
    nodes = nn_descent.distinct_vectors(df)
    ids = {r.rep: r.v for r in nodes.collect()}
    group = [ids[i] for i in [199, *range(220, 300)]]
    dense = spark.createDataFrame([(v, group[0], 1) for v in group], "v long, label long, weight long")
    links = spark.createDataFrame([(a, b) for a in group for b in group if a != b], "v long, u long")
    truth = nn_descent.audit(nn_descent.with_homes(nodes, None), 0.9, 1000, 0)
    assert nn_descent.audit_shares(truth, links, dense) == (0.0, 40, 40)
    half = links.union(spark.createDataFrame([(ids[i], ids[200 + i]) for i in range(20)], "v long, u long"))
    assert nn_descent.audit_shares(truth, half, dense) == (0.5, 40, 20)
    apart = nn_descent.audit(nn_descent.with_homes(nodes, dense), 0.9, 1000, 0)
    assert apart.count() == 40 and nn_descent.audit(nn_descent.with_homes(nodes, dense), 0.9, 300, 1).count() == 0


def test_recall_of_no_links_is_not_measured(spark):
    rows = list(enumerate(np.eye(12).tolist()))
    got = embedding_near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(got) == 12 and {r.audited_recall for r in got} == {None}


def test_effort_grows_with_size():
    sizes = [50_000, 500_000, 5_000_000, 50_000_000]
    got = [nn_descent.effort(n, 0.9, 4, 4) for n in sizes]
    for (trees, _), n in zip(got, sizes, strict=True):
        meet = (1 - np.arccos(0.9) / np.pi) ** nn_descent.start_bits(n)
        assert 1 - (1 - meet) ** trees >= 0.6
    assert got == sorted(got) and got[0] == (4, 6) and got[-1][0] > 12
    assert nn_descent.effort(1, 0.9, 4, 4) == (4, 4) and nn_descent.effort(10 ** 6, 1.0, 4, 4)[0] == 4


def test_passes_until_the_target(spark, monkeypatch):
    """Passes go on while links are found, and a target never met is an error."""
    vecs = planted(np.random.default_rng(6), 60, 30, 1)
    df = spark.createDataFrame(list(enumerate(vecs)), "vec_id long, embedding array<float>")
    real = nn_descent.start_blocks
    late = lambda homes, n, trees, *a: (real(homes, n, trees, *a) if trees.start >= 2
                                        else real(homes, n, trees, *a).filter("sim < 0.9"))
    monkeypatch.setattr(nn_descent, "refine", lambda homes, *a: real(homes, 1, range(1), 1, 2.0).filter("false"))
    monkeypatch.setattr(nn_descent, "start_blocks", late)
    got = embedding_near_dedup(df, trees=1, rounds=1, passes=2).collect()
    assert {r.audited_recall for r in got} == {1.0} and sum(r.n_links for r in got) >= 60
    monkeypatch.setattr(nn_descent, "start_blocks", lambda *a: real(*a).filter("sim < 0.9"))
    with pytest.raises(RuntimeError, match="below 0.98 after 3 passes"):
        embedding_near_dedup(df, trees=1, rounds=1, passes=2)
