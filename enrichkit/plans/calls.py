"""Rate-limited lookups with retries as data (UD-1, FN-18, AG-11).

``plan_calls`` gives every pending call a minute, so that no minute holds more
calls than the limit: its place in a global order, computed over partitions,
divided by the limit. ``run_calls`` looks planned calls up; calls that fail with a
status worth another try are planned again behind a back-off, up to a number of
tries, and the last outcome of every call stands. The plan is a table: what is
due in a minute is a filter, what a minute held is a count.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrichkit.operators.batching import global_rank
from enrichkit.session import cut_lineage

#: Statuses that are tried again.
TRY_AGAIN = ("500", "502", "503", "504")


def plan_calls(pending: DataFrame, order_by: Sequence[Column | str], per_minute: int, first_minute: int = 0) -> DataFrame:
    """``pending`` with ``minute``: at most ``per_minute`` calls in each, in the
    total order ``order_by``, from ``first_minute`` on without a gap."""
    if per_minute < 1:
        raise ValueError("the limit must allow a call a minute")
    ranked = global_rank(pending, order_by, "_rank")
    return ranked.withColumn("minute", (F.lit(first_minute) + F.floor((F.col("_rank") - 1) / per_minute)).cast("bigint")) \
        .drop("_rank")


def back_off(done: int, base: int = 1) -> int:
    """Minutes to wait after ``done`` failed tries: 1, 2, 4 times ``base``."""
    return base * 2 ** (done - 1)


def run_calls(pending: DataFrame, resolve: Callable[[DataFrame], DataFrame], key: str, order_by: Sequence[Column | str],
              per_minute: int, max_tries: int = 3, base_wait: int = 1, try_again: Sequence[str] = TRY_AGAIN) -> DataFrame:
    """Every try of every call: the columns of ``pending``, ``try`` (1 up),
    ``minute``, and ``payload, status, error`` as ``resolve`` gives them for
    planned calls (any lookup: a join, a partition function), and ``final``, true
    for a call's last try. A call without a key fails its check at once: it has
    no minute and takes none from the others.

    A round of tries starts when the round before is through and the back-off is
    over, so rounds never share a minute and a call waits at least its back-off.
    There are ``max_tries`` rounds at most; each is checkpointed, so a lost
    executor cannot plan a call twice."""
    keyed = F.col(key).isNotNull()
    unkeyed = resolve(pending.filter(~keyed).withColumn("try", F.lit(1)).withColumn("minute", F.lit(None).cast("bigint")))
    queue, start = pending.filter(keyed), 0
    rounds = [cut_lineage(unkeyed.withColumn("final", F.lit(True)))]
    for n in range(1, max_tries + 1):
        planned = plan_calls(queue.withColumn("try", F.lit(n)), order_by, per_minute, start)
        again = F.coalesce(F.col("status").isin(*try_again), F.lit(False)) if n < max_tries else F.lit(False)
        tried = cut_lineage(resolve(planned).withColumn("final", ~again))
        rounds.append(tried)
        last = tried.agg(F.max("minute").alias("last"), F.count_if(~F.col("final")).alias("left")).first()
        if not last["left"]:
            break
        start = last["last"] + 1 + back_off(n, base_wait)
        queue = tried.filter(~F.col("final")).select(*pending.columns)
    out = rounds[0]
    for r in rounds[1:]:
        out = out.unionByName(r)
    return out


def due(plan: DataFrame, minute: int) -> DataFrame:
    """The calls of one minute, for a worker that makes them."""
    return plan.filter(F.col("minute") == minute)
