"""Join operators (JN-1 .. JN-10).

Joins are plain DataFrame joins; Catalyst/AQE choose the strategy at run
time (broadcast only when the measured side is below the threshold, else a
shuffled sort-merge or hash join, with skew splitting on).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _on(left: DataFrame, right: DataFrame, key_map: Mapping[str, str]) -> Column:
    cond = None
    for lk, rk in key_map.items():
        c = left[lk] == right[rk]
        cond = c if cond is None else (cond & c)
    return cond


def bit_sketch(keys: Column, rows: DataFrame, bits: int) -> DataFrame:
    """``bucket, sketch``: which of 2**``bits`` hash values the keys have, as
    bitmaps of 4 KB; 2**``bits`` / 8 bytes at most, whatever the number of rows."""
    value = F.pmod(F.xxhash64(keys), F.lit(1 << bits))
    return (rows.filter(keys.isNotNull()).select(value.alias("v"))
            .groupBy(F.bitmap_bucket_number("v").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("sketch")))


def sieve(rows: DataFrame, key: Column, sketch: DataFrame, bits: int) -> DataFrame:
    """The rows whose key's bit is set: all that may match, few others. Works
    where the rows are read, before they are shuffled."""
    value = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    at = F.bitmap_bit_position(value)
    byte = F.conv(F.hex(F.substring(F.col("sketch"), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    set_ = F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1
    return rows.join(F.broadcast(sketch), F.bitmap_bucket_number(value) == F.col("bucket")).filter(set_).select(*rows.columns)


def exclude_processed(df: DataFrame, done: Sequence[tuple[DataFrame, Mapping[str, str]]],
                      sketch_bits: int | None = None) -> DataFrame:
    """JN-5 / JN-6 / ST-3: NOT EXISTS against several "already done" tables.

    Each entry is ``(done_df, {left_col: right_col})``; filter ``done_df``
    first for extra right-side predicates (JN-6). Only the key columns of the
    done side are read (column pruning reaches the scan), and they are
    de-duplicated first: the partial aggregate runs before the shuffle the
    join needs anyway, so a key repeated in many done rows costs one row per
    task, not one per copy.

    With ``sketch_bits`` the done tables are first sieved by a bitmap of the
    pending keys' hashes (2 MB for 24 bits, broadcast: its size does not depend
    on the data), so of a done table that is much larger than ``df`` only the
    keys that may match, and a share of about pending / 2**bits of the others,
    are shuffled. The pending keys are read once more for it. Types of a key
    must agree on both sides.
    """
    out = df
    for right, key_map in done:
        keys = right.select(*[F.col(rk) for rk in key_map.values()])
        if sketch_bits is not None:
            left = F.struct(*[F.col(k) for k in key_map]) if len(key_map) > 1 else F.col(next(iter(key_map)))
            seek = F.struct(*[F.col(k).alias(n) for n, k in key_map.items()]) if len(key_map) > 1 else F.col(keys.columns[0])
            if [keys.schema[k].dataType for k in key_map.values()] != [df.schema[k].dataType for k in key_map]:
                raise TypeError("a sketch needs keys of one type on both sides")
            keys = sieve(keys, seek, bit_sketch(left, df, sketch_bits), sketch_bits)
        keys = keys.distinct()
        out = out.join(keys, _on(out, keys, key_map), "left_anti")
    return out


def incremental(src: DataFrame, target: DataFrame, src_key: str, target_key: str) -> DataFrame:
    """JN-7: rows of ``src`` whose key is not in ``target`` yet
    (``LEFT JOIN target ... WHERE target.key IS NULL``, NULL src keys dropped).
    Target keys are de-duplicated first (a feature table with app fan-out
    repeats each key once per app)."""
    t = target.select(F.col(target_key).alias("_tk")).filter(F.col("_tk").isNotNull()).distinct()
    return (src.filter(F.col(src_key).isNotNull())
            .join(t, F.col(src_key) == F.col("_tk"), "left_anti"))


def keep_present(df: DataFrame, keys: DataFrame, key_map: Mapping[str, str]) -> DataFrame:
    """JN-10: semi join (``key IN (SELECT DISTINCT ...)``)."""
    return df.join(keys, _on(df, keys, key_map), "left_semi")


def flag_present(df: DataFrame, keys: DataFrame, left_key: str, right_key: str,
                 flag: str = "present") -> DataFrame:
    """JN-10 as a flag: ``CASE WHEN key IN (subquery)``. The right side is
    de-duplicated with a partial aggregate before it is shuffled, so the join
    cannot fan out."""
    k = (keys.select(F.col(right_key).alias("_fk")).filter(F.col("_fk").isNotNull())
         .distinct().withColumn("_hit", F.lit(True)))
    return (df.join(k, F.col(left_key) == F.col("_fk"), "left")
            .withColumn(flag, F.coalesce(F.col("_hit"), F.lit(False)))
            .drop("_fk", "_hit"))


def left_join_on_key_and_day(left: DataFrame, right: DataFrame,
                             left_key: str, right_key: str,
                             left_ts: str, right_ts: str) -> DataFrame:
    """JN-2: ``l.k = r.k AND DATE(r.ts) = DATE(l.ts)`` as a two-key equi join
    on derived date columns (both keys hash-partition the shuffle)."""
    l2 = left.withColumn("_ld", F.to_date(F.col(left_ts)))
    r2 = right.withColumn("_rd", F.to_date(F.col(right_ts)))
    cond = (l2[left_key] == r2[right_key]) & (l2["_ld"] == r2["_rd"])
    return l2.join(r2, cond, "left").drop("_ld", "_rd")
