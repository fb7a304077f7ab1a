"""Operator 6: embedding near-duplicates by NN-descent.

A neighbour graph over the distinct vectors is started from random-hyperplane
blocks and refined by neighbours-of-neighbours joins: everything that a node
lists, or that lists it, is compared with each other, and better neighbours
enter the lists, until few do. Lists whose places are all links are saturated
and enlarged: their nodes' components are settled by comparing them whole, in
blocks, so members of one's own component need no places, and the list gets
``k`` places for nodes outside it. Blocks and rounds are run again for these
until no list is filled by links only, so dense groups that touch are joined.
A brute-force audit of a bounded query sample measures
recall of the links that are not inside a component compared whole; below the
target, further blocks and rounds are run. Pairs at or above
the cosine threshold are the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from enrichkit.llm.common import components, left_lookup, materialize, whole_groups

#: Vectors in one start block and in one part of a reverse list.
LEAF, PART = 192, 24


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Unit rows in double precision of a list column of one length."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(arr), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``v, rep, weight, dim, vec``: one node per distinct usable vector."""
    ok = (F.col("vec").isNotNull() & (F.size("vec") > 0)
          & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
          & F.exists("vec", lambda x: x != 0))
    one = rows.filter(F.coalesce(ok, F.lit(False))).groupBy("vec").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    return materialize(one.select(F.monotonically_increasing_id().alias("v"), "rep", "weight",
                                  F.size("vec").alias("dim"), "vec"), "nn-nodes")


def with_homes(nodes: DataFrame, dense: DataFrame | None) -> DataFrame:
    """``v, dim, vec, home``: nodes of a component compared whole share a home,
    all others are their own."""
    if dense is None:
        return nodes.select("v", "dim", "vec", F.col("v").alias("home"))
    return (nodes.select("v", "dim", "vec").join(dense.select("v", "label"), "v", "left")
            .select("v", "dim", "vec", F.coalesce("label", "v").alias("home")))


def _top_pairs(ids: np.ndarray, x: np.ndarray, home: np.ndarray, k: int, floor: np.ndarray, threshold: float
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one group, each member's best ``k`` of other homes above its floor, and
    all of other homes at or above the threshold."""
    sim = x @ x.T
    sim[home[:, None] == home[None, :]] = -2.0
    if len(ids) > k + 1:
        edge = np.partition(sim, len(ids) - k, axis=1)[:, len(ids) - k]
    else:
        edge = np.full(len(ids), -1.5)
    a, b = np.nonzero((sim >= np.minimum(np.maximum(edge, floor), threshold)[:, None]) & (sim > -1.5))
    return ids[a], ids[b], sim[a, b]


def _pair_batch(found: list[tuple]) -> pa.RecordBatch:
    cols = [np.concatenate(c) for c in zip(*found, strict=True)]
    return pa.record_batch([pa.array(c) for c in cols], names=["v", "u", "sim"])


def start_bits(n: int) -> int:
    """Hyperplanes a tree: one more for every doubling of the nodes."""
    return max(0, math.ceil(math.log2(max(n, 1) / (LEAF / 2))))


def effort(n: int, threshold: float, trees: int, rounds: int, start_recall: float = 0.6) -> tuple[int, int]:
    """Trees and rounds of a pass over ``n`` nodes, at least those given. Trees
    grow so that a pair at the threshold meets in one of a pass's start blocks
    with probability ``start_recall`` at any size; rounds with the logarithm."""
    meet = (1 - math.acos(min(max(threshold, 0.5), 1.0)) / math.pi) ** start_bits(n)
    need = math.ceil(math.log(1 - start_recall) / math.log(1 - meet)) if meet < 1 else 1
    return max(trees, need), max(rounds, math.ceil(math.log2(max(n, 2)) / 3))


def start_blocks(homes: DataFrame, n: int, trees: range, k: int, threshold: float) -> DataFrame:
    """Pairs within blocks of vectors on the same side of random hyperplanes,
    several sets of planes at once. A block that is still too large is dealt
    into parts by a hash."""
    bits = start_bits(n)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(1).to_numpy(zero_copy_only=False)
            unit = {int(d): (at := np.flatnonzero(dims == d), _matrix(b.column(2).take(pa.array(at))))
                    for d in np.unique(dims)}
            for tree in trees:
                side = np.zeros(len(dims), np.int64)
                for dim, (at, x) in unit.items():
                    planes = np.random.default_rng([tree, dim]).standard_normal((dim, bits))
                    side[at] = (x @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64))
                yield pa.record_batch([b.column(0), b.column(1), b.column(2), b.column(3), pa.array(side),
                                       pa.array(np.full(len(dims), tree))],
                                      names=["v", "dim", "vec", "home", "side", "tree"])

    vec_type = homes.schema["vec"].dataType.simpleString()
    sided = materialize(homes.select("v", "dim", "vec", "home").mapInArrow(
        keys, f"v long, dim int, vec {vec_type}, home long, side long, tree long"), "nn-sides")
    where = ["tree", "dim", "side"]
    size = materialize(sided.groupBy(*where).agg(F.count(F.lit(1)).alias("c")), "nn-sizes")
    parts = F.pmod(F.xxhash64("v", "tree"), F.ceil(F.col("c") / (4 * LEAF)).cast("long"))
    dealt = sided.join(size, where).select(F.xxhash64(*where, parts).alias("block"), "dim", "v", "vec", "home")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts, ends in whole_groups(batches):
            ids, dims, home = (t.column(i).to_numpy() for i in (2, 1, 4))
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                if e - s > 1 and dims[s] == dims[e - 1]:
                    got = _top_pairs(ids[s:e], _matrix(t.column(3).slice(s, e - s)), home[s:e], k,
                                     np.full(e - s, -1.0), threshold)
                    if len(got[0]):
                        yield _pair_batch([got])

    ordered = dealt.repartition("block").sortWithinPartitions("block", "dim")
    return ordered.mapInArrow(run, "v long, u long, sim double")


def merge_lists(lists: DataFrame | None, found: DataFrame, dense: DataFrame | None, k: int, threshold: float,
                name: str) -> DataFrame:
    """Each node's best ``k`` neighbours and all links among those found;
    ``fresh`` marks what was not listed before, ``place`` is the rank. A node of
    a ``dense`` component has a longer list (``wide``): neighbours in the
    component (``inner``) and others are ranked apart, with ``k`` places each."""
    new = found.select("v", "u", "sim", F.lit(1).alias("fresh"))
    rows = new if lists is None else new.unionByName(lists.select("v", "u", "sim", F.lit(0).alias("fresh")))
    one = rows.groupBy("v", "u").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    if dense is None:
        one = one.withColumn("wide", F.lit(False)).withColumn("inner", F.lit(False))
    else:
        one = (one.join(dense.select("v", F.col("label").alias("lv")), "v", "left")
               .join(dense.select(F.col("v").alias("u"), F.col("label").alias("lu")), "u", "left")
               .select("v", "u", "sim", "fresh", F.col("lv").isNotNull().alias("wide"),
                       F.coalesce(F.col("lv") == F.col("lu"), F.lit(False)).alias("inner")))
    place = F.row_number().over(Window.partitionBy("v", "inner").orderBy(F.col("sim").desc(), "u"))
    return materialize(one.withColumn("place", place).filter(
        (F.col("place") <= k) | (F.col("sim") >= threshold)), name)


def refine(homes: DataFrame, lists: DataFrame, k: int, threshold: float, salt: int) -> DataFrame:
    """Neighbours-of-neighbours join: compares what lists ``w`` and what ``w``
    lists, for all ``w`` with something new. Long reverse lists are dealt into
    parts, each compared with the node's own list. Pairs of one home are left out."""
    near = lists.filter(F.col("place") <= k)
    floor = near.filter((F.col("place") == k) & ~F.col("inner")).select(F.col("v").alias("u"), F.col("sim").alias("floor"))
    out = near.select(F.col("v").alias("w"), "u", "fresh")
    back = near.select(F.col("u").alias("w"), F.col("v").alias("u"), "fresh")
    fans = back.groupBy("w").agg(F.ceil(F.count(F.lit(1)) / F.lit(PART)).cast("long").alias("parts"))
    moved = near.filter("fresh = 1").select(F.col("v").alias("w")).union(
        near.filter("fresh = 1").select(F.col("u").alias("w"))).distinct()
    hubs = materialize(moved.join(fans, "w", "left").select("w", F.coalesce("parts", F.lit(1)).alias("parts")),
                       f"nn-hubs{salt}")
    part = F.pmod(F.xxhash64("u", F.lit(salt)), F.col("parts"))
    members = (out.join(hubs, "w").select("w", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
                                          .alias("part"), "u")
               .union(back.join(hubs, "w").select("w", part.alias("part"), "u")).distinct())
    joined = (members.join(homes.select(F.col("v").alias("u"), "vec", "home"), "u").join(floor, "u", "left")
              .select(F.xxhash64("w", "part").alias("g"), "u", "vec", F.coalesce("floor", F.lit(-1.0)).alias("floor"),
                      F.size("vec").alias("dim"), "home"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts, ends in whole_groups(batches):
            ids, floors, dims, home = (t.column(i).to_numpy() for i in (1, 3, 4, 5))
            found = []
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                if e - s > 1 and dims[s] == dims[e - 1]:
                    got = _top_pairs(ids[s:e], _matrix(t.column(2).slice(s, e - s)), home[s:e], k, floors[s:e],
                                     threshold)
                    keep = got[2] > np.minimum(floors[s:e][np.searchsorted(ids[s:e], got[0])], threshold - 1e-12)
                    if keep.any():
                        found.append(tuple(c[keep] for c in got))
            if found:
                yield _pair_batch(found)

    ordered = joined.repartition("g").sortWithinPartitions("g", "dim", "u")
    return ordered.mapInArrow(run, "v long, u long, sim double").distinct()


def audit(homes: DataFrame, threshold: float, queries: int, block: int) -> DataFrame:
    """``v, u``: all links to other homes of the ``block``-th ``queries`` nodes
    of a sample, by brute force. Only the queries are broadcast."""
    some = (homes.orderBy(F.xxhash64("v", F.lit("audit")), "v").offset(block * queries).limit(queries)
            .select("v", "dim", "vec", "home").collect())
    by_dim: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for dim in {r["dim"] for r in some}:
        own = [r for r in some if r["dim"] == dim]
        x = np.array([r["vec"] for r in own], np.float64)
        by_dim[dim] = (np.array([r["v"] for r in own]), np.array([r["home"] for r in own]),
                       x / np.linalg.norm(x, axis=1, keepdims=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, dims, home = (b.column(i).to_numpy() for i in (0, 1, 3))
            for dim in np.unique(dims):
                if int(dim) not in by_dim:
                    continue
                at = np.flatnonzero(dims == dim)
                qid, qhome, q = by_dim[int(dim)]
                for lo in range(0, len(at), 4096):
                    some_at = at[lo:lo + 4096]
                    i, j = np.nonzero(q @ _matrix(b.column(2).take(pa.array(some_at))).T >= threshold)
                    other = qhome[i] != home[some_at][j]
                    yield pa.record_batch([pa.array(qid[i][other]), pa.array(ids[some_at][j][other])],
                                          names=["v", "u"])

    return materialize(homes.select("v", "dim", "vec", "home").mapInArrow(run, "v long, u long"),
                       f"nn-audit{block}")


def audit_shares(truth: DataFrame, links: DataFrame, dense: DataFrame) -> tuple[float | None, int, int]:
    """(recall, audited nodes, links missed) of the true links that are not
    inside one dense component. Recall is the mean of the audited nodes' shares,
    so a node with many links counts as one; None when there are no such links."""
    lab = dense.select("v", F.col("label").alias("lv"))
    apart = (truth.join(lab, "v", "left").join(lab.withColumnsRenamed({"v": "u", "lv": "lu"}), "u", "left")
             .filter(~F.coalesce(F.col("lv") == F.col("lu"), F.lit(False))).select("v", "u"))
    found = links.select("v", "u", F.lit(1).alias("hit"))
    each = apart.join(found, ["v", "u"], "left").groupBy("v").agg(
        F.count("hit").alias("found"), F.count(F.lit(1)).alias("there"))
    row = each.agg(F.avg(F.col("found") / F.col("there")).alias("recall"), F.count(F.lit(1)).alias("n"),
                   F.coalesce(F.sum(F.col("there") - F.col("found")), F.lit(0)).alias("missed")).first()
    return row["recall"], row["n"], row["missed"]


def whole_components(nodes: DataFrame, members: DataFrame, threshold: float, block: int = 512) -> DataFrame:
    """``v, n_links`` counted over all pairs of nodes of one component, block
    against block; no pair is emitted. ``members`` has ``v, label, weight``."""
    sizes = materialize(members.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("long")
                                                     .alias("blocks")), "nn-blocks")
    own = F.pmod(F.xxhash64("v", F.lit("block")), F.col("blocks"))
    placed = materialize(members.join(sizes, "label").select("v", "label", "weight", "blocks", own.alias("own"))
                         .join(nodes.select("v", "dim", "vec"), "v"), "nn-placed")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    both = placed.select("label", "own", "v", "weight", "dim", "vec", other).select(
        F.xxhash64("label", F.least("own", "other"), F.greatest("own", "other")).alias("g"),
        (F.col("own") <= F.col("other")).alias("low"), (F.col("own") == F.col("other")).alias("same"),
        "v", "weight", "dim", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts, ends in whole_groups(batches):
            low, same, ids, weight = (t.column(i).to_numpy() for i in (1, 2, 3, 4))
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                x = _matrix(t.column(6).slice(s, e - s))
                if same[s]:
                    hit = x @ x.T >= threshold
                    np.fill_diagonal(hit, False)
                    yield _count_batch(ids[s:e], hit @ weight[s:e])
                else:
                    a, b = np.flatnonzero(low[s:e]), np.flatnonzero(~low[s:e])
                    hit = x[a] @ x[b].T >= threshold
                    yield _count_batch(ids[s:e][a], hit @ weight[s:e][b])
                    yield _count_batch(ids[s:e][b], hit.T @ weight[s:e][a])

    counts = both.repartition("g").sortWithinPartitions("g", "low", "v").mapInArrow(run, "v long, links long")
    return counts.groupBy("v").agg(F.sum("links").alias("n_links"))


def _count_batch(ids: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(ids), pa.array(links.astype(np.int64))], names=["v", "links"])


def saturated(links: DataFrame, homes: DataFrame, k: int, name: str) -> DataFrame:
    """Nodes with links in all ``k`` places for nodes of other homes."""
    home = homes.select("v", "home")
    other = (links.join(home, "v").join(home.select(F.col("v").alias("u"), F.col("home").alias("there")), "u")
             .filter(F.col("home") != F.col("there")))
    return materialize(other.groupBy("v").agg(F.count(F.lit(1)).alias("degree"))
                       .filter(F.col("degree") >= k).select("v"), name)


def dense_components(nodes: DataFrame, labels: DataFrame, full: DataFrame, before: DataFrame | None, name: str
                     ) -> DataFrame:
    """``v, label, weight`` of the components that hold a node that is, or was
    ``before``, saturated."""
    ever = full if before is None else full.union(before.select("v"))
    held = labels.join(ever.distinct(), "v").select("label").distinct()
    return materialize(labels.join(held, "label").join(nodes.select("v", "weight"), "v"), name)


def embedding_near_dedup(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                         threshold: float = 0.9, k: int = 10, trees: int = 4, rounds: int = 4,
                         settled: float = 0.01, audit_queries: int = 1000, recall_target: float = 0.98,
                         passes: int = 3, audit_blocks: int = 8, audit_enough: int = 100) -> DataFrame:
    """Links of cosine at least ``threshold`` and their components.

    Returns one row per input row: ``vec_id, n_links`` (other rows linked
    directly), ``component_id`` (smallest id reachable), ``kept`` (the row is its
    component's smallest) and ``audited_recall`` of the last audit. The audit
    leaves out links inside components compared whole, and draws up to
    ``audit_blocks`` blocks of ``audit_queries`` nodes until ``audit_enough`` of
    them have other links; ``audited_recall`` is null (not measured) if none has.
    Passes go on until recall is ``recall_target``; ``passes`` in a row that
    find no audited link more raise an error.

    Defined cases: vectors that are null, empty, zero or hold null or non-finite
    components link with nothing and are components of their own. Vectors of
    different lengths never link. Equal vectors are one node and all linked;
    repeated rows are equal vectors, and of rows with the smallest id all have
    ``kept``. Null ids take part in links; ``component_id`` ignores them and is
    null when a component has no other. An empty table gives no rows. Extra
    columns are ignored.
    """
    base = rows.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vec"))
    nodes = distinct_vectors(base)
    n = nodes.count()
    trees, rounds = effort(n, threshold, trees, rounds)
    lists, recall, links, dense, attempt, truth, blocks = None, None, None, None, 0, None, 0
    least_missed, stale = None, 0
    while n > 1:
        homes = with_homes(nodes, dense)
        found = start_blocks(homes, n, range(attempt * trees, (attempt + 1) * trees), k, threshold)
        lists = merge_lists(lists, found, dense, k, threshold, f"nn-start{attempt}")
        wide_n = 0 if dense is None else dense.count()
        for r in range(rounds):
            got = refine(homes, lists, k, threshold, attempt * rounds + r)
            lists = merge_lists(lists, got, dense, k, threshold, f"nn-lists{attempt}-{r}")
            new = lists.filter((F.col("fresh") == 1) & (F.col("place") <= k) & ~F.col("inner")).agg(
                F.count(F.lit(1)).alias("n"), F.count_if("wide").alias("wide")).first()
            if new["n"] <= settled * n * k and new["wide"] <= settled * wide_n * k:
                break
        hit = lists.filter(F.col("sim") >= threshold).select("v", "u")
        links = materialize(hit.union(hit.select(F.col("u").alias("v"), F.col("v").alias("u"))).distinct(),
                            f"nn-links{attempt}")
        labels = components(links, "v", "u").withColumnRenamed("node", "v")
        full = saturated(links, homes, k, f"nn-full{attempt}")
        dense = dense_components(nodes, labels, full, dense, f"nn-dense{attempt}")
        grown = not full.isEmpty()
        seen = 0
        if truth is not None:
            recall, seen, missed = audit_shares(truth, links, dense)
        while seen < audit_enough and blocks < audit_blocks and blocks * audit_queries < n:
            more = audit(with_homes(nodes, dense), threshold, audit_queries, blocks)
            truth, blocks = more if truth is None else truth.unionByName(more), blocks + 1
            recall, seen, missed = audit_shares(truth, links, dense)
            least_missed = None
        attempt += 1
        if not grown and (recall is None or recall >= recall_target):
            break
        # links only grow, so with a settled sample fewer are missed or none was gained
        gained = grown or least_missed is None or missed < least_missed
        least_missed, stale = missed, 0 if gained else stale + 1
        if stale >= passes:
            raise RuntimeError(f"recall {recall:.4f} is below {recall_target} after {attempt} passes, the last "
                               f"{stale} of which found no audited link")
    if links is None:
        counted = nodes.select("v", "rep", F.col("weight"), F.lit(0).cast("long").alias("n_links"),
                               F.col("v").alias("label"))
    else:
        sparse = (links.join(dense.select("v"), "v", "left_anti")
                  .join(nodes.select(F.col("v").alias("u"), "weight"), "u")
                  .groupBy("v").agg(F.sum("weight").alias("n_links")))
        both = materialize(sparse.unionByName(whole_components(nodes, dense, threshold)), "nn-counts")
        counted = (nodes.select("v", "rep", "weight").join(both, "v", "left")
                   .join(labels, "v", "left")
                   .withColumn("label", F.coalesce("label", "v")).withColumn("n_links", F.coalesce("n_links", F.lit(0))))
    least = counted.groupBy("label").agg(F.min("rep").alias("component_id"))
    known = materialize(counted.join(least, "label").join(nodes.select("v", "vec"), "v").select(
        "vec", (F.col("n_links") + F.col("weight") - 1).alias("n_links"), "component_id",
        F.lit(True).alias("usable")), "nn-result")
    out = left_lookup(base, known, ["vec"])
    comp = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), comp.alias("component_id"),
                      F.col("vec_id").eqNullSafe(comp).alias("kept"), F.lit(recall).cast("double").alias("audited_recall"))
