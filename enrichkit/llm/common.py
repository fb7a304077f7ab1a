"""Helpers shared by the training-data operators.

Every operator reads only the columns it names and renames them to internal
names first, so extra columns and clashing names in the input never matter.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from enrichkit.session import scratch_path

#: ASCII white space: the separators of all word contracts.
WORD_RE = "[^\\x20\\x09-\\x0D]+"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once into the cluster's shared checkpoint folder and read
    it back: cuts lineage in a way that survives lost executors, and fixes
    values such as generated ids for every later use."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole test table, by Spark's reader only (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def empty_text(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on all keys (Spark plans it as a hash / merge join)."""
    cond = None
    for k in keys:
        c = a[k].eqNullSafe(b[k])
        cond = c if cond is None else cond & c
    return cond


def left_lookup(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``b`` to ``a`` on null-safe keys and keep one set of key columns."""
    renamed = b.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                       *[c for c in b.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    out = a.join(renamed, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_r_{k}" for k in keys])


def dense_rank_global(df: DataFrame, order_by: Sequence[Column | str], name: str,
                      scratch: str = "rank") -> DataFrame:
    """0-based position of each row in a total order, without a one-task
    window over the rows: a range-partitioned sort is written once with its
    partition numbers, then a per-partition offset (one row per partition,
    bounded by the partition count) is broadcast back."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    idx = materialize(df.orderBy(*cols).withColumn("_mid", F.monotonically_increasing_id()), scratch)
    part = F.shiftright("_mid", 33)
    per = idx.groupBy(part.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = per.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (idx.withColumn("_pid", part).join(F.broadcast(off), "_pid")
            .withColumn(name, F.col("_off") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_pid", "_mid", "_off"))


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 200) -> DataFrame:
    """Connected components of an undirected graph of long node ids.

    Returns ``(node, label)``, one row per node that has an edge; ``label`` is
    some node of the component, the same for all of it. Random-priority
    contraction: each round every node points at the neighbour (or itself)
    with the smallest hash of (node, round), edges are relabelled, loops and
    repeats go. The number of nodes shrinks by a constant factor a round, so
    long chains need O(log n) rounds; a hub costs one partial aggregate.
    """
    e = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a <> b")
    e = materialize(e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    lab = materialize(e.select(F.col("a").alias("node")).distinct()
                      .withColumn("label", F.col("node")), "cc-lab")
    for r in range(max_rounds):
        if e.isEmpty():
            return lab
        pr = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(r)).alias("h"), F.col(c).alias("v"))
        step = materialize(
            e.groupBy("a").agg(F.min(pr("b")).alias("m"))
            .select("a", F.least(F.col("m"), pr("a"))["v"].alias("p")), f"cc-step{r}")
        lab = materialize(
            lab.join(step.select(F.col("a").alias("label"), "p"), "label", "left")
            .select("node", F.coalesce("p", "label").alias("label")), f"cc-lab{r}")
        e = materialize(
            e.join(step.select("a", F.col("p").alias("pa")), "a")
            .join(step.select(F.col("a").alias("b"), F.col("p").alias("pb")), "b")
            .filter("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(),
            f"cc-edges{r}")
    raise RuntimeError(f"components did not converge in {max_rounds} rounds")


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply) on uint64 values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hash(units: np.ndarray, k: int, base: int) -> np.ndarray:
    """Polynomial hash (mod 2**64) of every ``k`` consecutive units, by
    doubling: O(len * log k) and no loop over positions."""
    n = len(units) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    mask = (1 << 64) - 1
    out, done, h, width, power = None, 0, units.astype(np.uint64), 1, base
    bits = k
    while bits:
        if bits & 1:
            # append this power-of-two block after what is hashed so far
            blk = h[done:]
            out = blk if out is None else out[:len(blk)] * np.uint64(power) + blk
            done += width
        bits >>= 1
        if bits:
            h = h[:-width] * np.uint64(power) + h[width:]
            power = power * power & mask
            width *= 2
    return out[:n]


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, by doubling."""
    m, k = x, 1
    if len(x) < w:
        return x[:0]
    while 2 * k <= w:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    if k < w:
        m = np.minimum(m[:len(m) - (w - k)], m[w - k:])
    return m


def give_back() -> None:
    """Return freed memory of a Python worker to the system: the Arrow pool and
    the C heap keep what one long text took for the worker's whole life else."""
    import ctypes
    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make a session ready for the operators: Arrow batches of at most 4 MB,
    so that long texts cannot fill a task's memory, and this package's code sent
    to the executors (once per application), so that Python tasks can import it
    wherever the driver was started."""
    import shutil
    import tempfile
    from pathlib import Path
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = Path(__file__).resolve().parents[2]
    target = Path(tempfile.mkdtemp(prefix="enrichkit-code-")) / "enrichkit"
    spark.sparkContext.addPyFile(shutil.make_archive(str(target), "zip", root, "enrichkit"))


def whole_groups(batches, key: int = 0):
    """From Arrow batches sorted by column ``key``: ``(table, starts, ends)``
    with whole groups only; the group a batch breaks off in is carried on."""
    import pyarrow as pa
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = t if held is None else pa.concat_tables([held, t])
        k = t.column(key).to_numpy()
        other = np.flatnonzero(k != k[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        held = t.slice(cut)
        if cut:
            yield _grouped(t.slice(0, cut), k[:cut])
    if held is not None:
        yield _grouped(held, held.column(key).to_numpy())


def _grouped(t, k: np.ndarray):
    starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    return t.combine_chunks(), starts, np.r_[starts[1:], len(k)]
