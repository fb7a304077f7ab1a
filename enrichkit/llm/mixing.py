"""Operator 8: mixing sources to target weights by entropy balancing.

Every source gets a token target (its weight's share of all tokens, at most
``cap`` times its size, the excess shared again by weight). Document rates are
the ones closest to 1 in relative entropy that meet the targets with no rate
above ``cap``: the solution of the convex dual is an exponential tilt,
``rate = min(cap, exp(lambda_source * size / mean_size))``, and lambda is found
by safeguarded Newton steps, each one distributed aggregate over (source, size)
counts. Rates are rounded into copies so that each source's tokens end close to
its target.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from enrichkit.llm.common import WORD_RE, dense_rank_global, empty_text, left_lookup, materialize


def word_count(text_col: str = "text") -> Column:
    return F.regexp_count(empty_text(text_col), F.lit(WORD_RE)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """``source, sid, n_docs, source_size, min_size, target`` per source.

    ``sizes`` has ``source`` and ``size``. Sources in code-point order, null
    last, take the weights in turn. The water level is found with two scalars a
    step; a source once capped stays capped as the level only rises."""
    per = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("min_size"))
    ranked = dense_rank_global(per, [F.col("source").asc_nulls_last()], "sid", "mix-sources")
    src = materialize(ranked.withColumn("turn", (F.col("sid") % len(weights)).cast("int"))
                      .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("turn") + 1)),
                      "mix-weights")
    most = F.lit(float(cap)) * F.col("source_size")
    level = 0.0
    while True:
        over = F.lit(level) * F.col("weight") > most
        # whole numbers a turn, weighed in the order of the turns: the same in every run
        turns = src.groupBy("turn").agg(
            F.sum("source_size").alias("size"), F.coalesce(F.sum(F.when(over, F.col("source_size"))), F.lit(0)).alias("fixed"),
            F.count(F.when(~over, F.lit(1))).alias("free")).orderBy("turn").collect()
        free = sum(weights[r["turn"]] * r["free"] for r in turns)
        if not free:
            break
        new = (sum(r["size"] or 0 for r in turns) - cap * sum(r["fixed"] for r in turns)) / free
        if new <= level * (1 + 1e-15):
            break
        level = new
    return src.withColumn("target", F.least(most, F.lit(level) * F.col("weight"))).drop("weight", "turn")


def exact_sum(col: Column) -> Column:
    """A sum of doubles that does not depend on their order: to 15 decimals each,
    totals below 1e23."""
    return F.sum(col.cast("decimal(38,15)")).cast("double")


def solve_tilts(groups: DataFrame, src: DataFrame, cap: float, tolerance: float = 1e-9,
                max_steps: int = 80) -> DataFrame:
    """``sid, lam``: the dual variable of every source (null: all at the cap).

    ``groups`` has ``sid, size, n``. One Newton step for all sources is one
    aggregate of shares of the target; a step that leaves the bracket [lo, hi] is
    replaced by bisection. Sums are exact, so lam is the same in every run."""
    full = F.col("target") >= F.lit(float(cap)) * F.col("source_size") * (1 - 1e-12)
    state = materialize(
        src.filter("source_size > 0").filter(~full)
        .withColumn("scale", F.col("source_size") / F.col("n_docs"))
        .select("sid", "target", "scale", F.lit(0.0).alias("lam"),
                F.lit(None).cast("double").alias("lo"),
                (F.lit(math.log(cap)) * F.col("scale") / F.col("min_size")).alias("hi"),
                F.lit(1.0).alias("gap")), "mix-state")
    for step in range(max_steps):
        x = F.col("size") / F.col("scale")
        raw = F.exp(F.least(F.col("lam") * x, F.lit(math.log(cap))))
        free = F.col("lam") * x < math.log(cap)
        mass = F.col("n") * F.col("size") * raw / F.col("target")
        sums = (groups.join(state, "sid").groupBy("sid")
                .agg(exact_sum(mass).alias("f"), exact_sum(F.when(free, mass * x).otherwise(0.0)).alias("df")))
        resid = F.col("f") - 1.0
        lo = F.when(resid < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(resid >= 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - resid / F.col("df")
        # without a lower end the bracket doubles outward
        low = F.coalesce(lo, F.least(hi, F.lit(0.0)) * 2 - 4.0)
        good = (F.col("df") > 0) & (newton > low) & (newton < hi)
        state = materialize(
            state.join(sums, "sid").select(
                "sid", "target", "scale",
                F.when(F.abs(resid) <= F.lit(tolerance), F.col("lam"))
                .when(good, newton).otherwise((low + hi) / 2).alias("lam"),
                lo.alias("lo"), hi.alias("hi"),
                F.abs(resid).alias("gap")), f"mix-state{step}")
        worst = state.agg(F.max("gap")).first()[0]
        if worst is None or worst <= tolerance:
            break
    return state.select("sid", "lam")


def _carry_extras(groups: pd.DataFrame, cap: float) -> pd.DataFrame:
    """Extra copies of each size of one source, error carried to the next
    shorter size. The rows are a source's distinct sizes, so their number is
    bounded by the longest document, not by the corpus."""
    g = groups.sort_values("size", ascending=False)
    out, carry = [], 0.0
    for size, n, whole, part in zip(g["size"], g["n"], g["whole"], g["part"], strict=True):
        most = n if size > 0 and whole + 1 <= cap else 0
        want = n * part + (carry / size if size > 0 else 0.0)
        extra = min(max(round(want), 0), most)
        carry = (want - extra) * size
        out.append(extra)
    return pd.DataFrame({"sid": g["sid"], "size": g["size"], "extras": out})


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: float = 3.0, id_col: str = "doc_id",
        source_col: str = "source", size: Column | None = None, carry: dict[str, Column] | None = None
        ) -> DataFrame:
    """Copies of every document so that each source meets its token target.

    ``size`` is the token count (default: words of ``text``). Returns one row
    per input row: ``doc_id, source, size, source_size, target, rate, copies,
    taken`` and the ``carry`` columns. ``copies`` is 0 to ``cap``; ``taken`` is
    copies times size; reruns agree.

    Defined cases: a null text has size 0; a null source is a source of its
    own, ordered last; a null id is an id like any other. Documents of size 0
    get one copy, which takes nothing. A source of size 0 has target 0. Rows
    repeated with one id are rounded one by one. An empty table gives no rows.
    Extra columns are ignored. The cap must be at least 1.
    """
    if cap < 1:
        raise ValueError("cap must be at least 1, or the targets cannot be met")
    carry = carry or {}
    rows = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        (word_count() if size is None else size.cast("long")).alias("size"),
        *[c.alias(f"c_{k}") for k, c in carry.items()]), "mix-rows")
    src = materialize(source_targets(rows, weights, cap), "mix-targets")
    groups = materialize(left_lookup(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")),
                                     src, ["source"])
                         .select("source", "sid", "size", "n", "source_size", "target",
                                 (F.col("source_size") / F.col("n_docs")).alias("scale")), "mix-groups")
    tilts = solve_tilts(groups.filter("size > 0").select("sid", "size", "n"), src, cap)
    tilt = F.exp(F.least(F.col("lam") * F.col("size") / F.col("scale"), F.lit(math.log(cap))))
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(F.coalesce(tilt, F.lit(float(cap))))
    rated = materialize(
        groups.join(tilts, "sid", "left").withColumn("rate", rate)
        .withColumn("whole", F.floor(F.col("rate") + 1e-9))
        .withColumn("part", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0)))
        .drop("lam", "scale"), "mix-rated")
    # Rounding. Along a source's sizes, longest first, each (source, size) group
    # gets a whole number of extra copies and hands what it misses on, so a
    # source ends within about its shortest document of the target. A group's n
    # documents are dealt into about sqrt(n) cells by a hash of the id, each with
    # its exact share of the extras, so no group is ever sorted in one piece.
    extras = materialize(rated.groupBy("sid").applyInPandas(
        lambda g: _carry_extras(g, cap), "sid long, size long, extras long"), "mix-extras")
    rated = materialize(rated.join(extras, ["sid", "size"]), "mix-rounded")
    h = F.xxhash64("doc_id", F.lit("cell"))
    dealt = materialize(left_lookup(rows, rated, ["source", "size"])
                        .withColumn("cell", F.pmod(h, F.ceil(F.sqrt("n")).cast("long"))), "mix-dealt")
    upto = Window.partitionBy("sid", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum("m").over(upto)
    cells = (dealt.groupBy("sid", "size", "cell").agg(
        F.count(F.lit(1)).alias("m"), F.first("n").alias("n"), F.first("extras").alias("extras"))
        .withColumn("end", end)
        .selectExpr("sid", "size", "cell", "(end * extras) div n - ((end - m) * extras) div n AS extra"))
    order = Window.partitionBy("sid", "size", "cell").orderBy(F.xxhash64("doc_id", F.lit("order")), "doc_id")
    copies = F.col("whole") + F.when(F.col("nth") <= F.col("extra"), 1).otherwise(0)
    return (dealt.join(cells, ["sid", "size", "cell"]).withColumn("nth", F.row_number().over(order))
            .withColumn("copies", copies.cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "rate", "copies",
                    (F.col("copies") * F.col("size")).alias("taken"),
                    *[F.col(f"c_{k}").alias(k) for k in carry]))
