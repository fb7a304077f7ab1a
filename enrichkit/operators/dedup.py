"""Latest row per key (WN-1 .. WN-5) and distinct projection (AG-9).

``ROW_NUMBER() OVER (PARTITION BY k ORDER BY d DESC) = 1`` is written as a
window plus a filter; Catalyst turns the pair into a WindowGroupLimit, which
also runs a partial per-key limit *before* the shuffle, so a key holding a
third of all rows is cut to one row per input partition before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from enrichkit.session import cut_lineage

_RN = "_rn"


def _cols(xs: Sequence[Column | str]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def latest_per_key(df: DataFrame, keys: Sequence[str | Column],
                   order_by: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order_by``.

    ``order_by`` must be a total order inside a key (add tie-breakers), or
    the chosen row is arbitrary, as in the reference.
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order_by))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_then_filter(df: DataFrame, keys: Sequence[str | Column],
                       order_by: Sequence[Column | str], predicate: Column) -> DataFrame:
    """WN-3: rank first, then apply the predicate to the winner only, so a
    key whose newest row is a success is not retried for an older failure."""
    return latest_per_key(df, keys, order_by).filter(predicate)


#: Bytes of keys and order columns that one broadcast side may hold.
BROADCAST_BYTES = 32 << 20


def latest_unseen(df: DataFrame, key: str, order_by: Sequence[tuple[str, bool]], seen: DataFrame | None = None,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """WN-1 and JN-7 with late materialisation: the first row per ``key`` (null
    keys dropped) under ``order_by`` (column, descending), of keys that ``seen``
    (one column) does not hold. Equal to ``incremental`` and ``latest_per_key``,
    but wide columns stay where they are read.

    A narrow pass over key and order columns alone finds the rows that stay (a
    partial limit cuts a hot key before it moves); they are checkpointed and
    measured. Where they fit ``broadcast_bytes``, the wide rows are filtered in
    place by a broadcast of them, else by one of the rows that go, if those fit;
    where neither does, the wide rows meet the rows that stay in one shuffled semi
    join on key and order columns, so a hot key is dealt by its versions and no
    wide row is ranked. Rows that agree in key and all order columns are ranked
    by a shuffle, these alone."""
    order = [F.col(c).desc() if desc else F.col(c).asc() for c, desc in order_by]
    names = [key, *[c for c, _ in order_by]]
    rows = df.filter(F.col(key).isNotNull())
    old = None
    if seen is not None:
        old = seen.select(F.col(seen.columns[0]).alias("_old")).filter(F.col("_old").isNotNull()).distinct()
    fresh = lambda frame: frame if old is None else frame.join(old, F.col(key) == F.col("_old"), "left_anti")
    narrow = rows.select(*names)
    first = fresh(narrow).withColumn(_RN, F.rank().over(Window.partitionBy(key).orderBy(*order))).filter(F.col(_RN) == 1)
    stays = cut_lineage(first.groupBy(*names).agg(F.count(F.lit(1)).alias("_copies")))
    side, how = stays, "left_semi"
    fits = (held := _size(stays, names, F.col("_copies")))["once"] <= broadcast_bytes
    if not fits and _size(narrow, names)["bytes"] - held["bytes"] <= broadcast_bytes:
        side, how, fits = cut_lineage(narrow.distinct().join(_renamed(stays, names), _same(names), "left_anti")), "left_anti", True
    side = _renamed(side, names)
    left = rows.join(F.broadcast(side) if fits else side, _same(names), how)
    tied = stays.filter("_copies > 1").select(F.col(key).alias("_tied"))
    if tied.isEmpty():
        return left
    on = F.col(key) == F.col("_tied")
    return left.join(tied, on, "left_anti").unionByName(latest_per_key(left.join(tied, on, "left_semi"), [key], order))


def _size(rows: DataFrame, names: Sequence[str], times: Column | None = None):
    """Row with ``once``, an upper estimate of a broadcast of the columns, and
    ``bytes``, the same with each row counted so many times."""
    size = sum([F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 32 for c in names], F.lit(0))
    size, times = size.cast("long"), F.lit(1) if times is None else times
    return rows.agg(F.coalesce(F.sum(size), F.lit(0)).alias("once"),
                    F.coalesce(F.sum(size * times), F.lit(0)).alias("bytes")).first()


def _renamed(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"_r_{i}") for i, c in enumerate(names)])


def _same(names: Sequence[str]) -> Column:
    """A plain equality on the key, null-safe ones on the order columns."""
    cond = F.col(names[0]) == F.col("_r_0")
    for i, c in enumerate(names[1:], 1):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{i}"))
    return cond


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AG-9 (SELECT DISTINCT); partial aggregation de-duplicates map-side."""
    return (df.select(*cols) if cols else df).distinct()
