"""Operator 10: exact duplicates by deterministic block naming.

Texts are cut into fixed-size byte blocks. The distinct blocks are sorted and
each gets an integer name; then adjacent pairs of names are named the same way,
level by level, until a document is one integer. Names come from sorted
distinct values, never from a hash, so two documents get one identity exactly
when their bytes are equal.

A first naming round on small probes (length, head and tail bytes) decides all
documents that are alone in their probe class: they equal no other text, and
only the rest goes through the block levels. That is exact, because equal texts
have equal probes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichkit.llm.common import empty_text, left_lookup, materialize


def _names(keys: DataFrame, cols: list[str], name: str) -> DataFrame:
    """Integer names in sorted order of the distinct keys, by a hash and then
    the key itself (the hash only spreads the sort evenly). The ids grow with
    the order and are written once, so a lost executor cannot rename."""
    ordered = (keys.select(*cols).distinct().withColumn("_h", F.xxhash64(*cols))
               .repartitionByRange("_h").sortWithinPartitions("_h", *cols))
    return materialize(ordered.withColumn("name", F.monotonically_increasing_id()).drop("_h"), name)


def block_identity(texts: DataFrame, keys: list[str], bytes_col: str, block_bytes: int) -> DataFrame:
    """One collision-free integer ``root`` per distinct key: equal exactly for
    equal byte strings. Empty strings have no block and return no row."""
    n = F.ceil(F.octet_length(bytes_col) / F.lit(block_bytes)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        i.alias("i"), F.substring(F.col(bytes_col), i * block_bytes + 1, F.lit(block_bytes)).alias("content")))
    blocks = materialize(texts.filter(F.octet_length(bytes_col) > 0)
                         .select(*keys, F.explode(cut).alias("b"))
                         .select(*keys, "b.i", "b.content"), "kmr-blocks")
    names = _names(blocks, ["content"], "kmr-names0")
    named = blocks.join(names, "content").select(*keys, "i", "name")
    top = blocks.agg(F.max("i")).first()[0]
    level = 0
    while top is not None and top > 0:
        pairs = materialize(
            named.groupBy(*keys, F.shiftright("i", 1).alias("i"))
            .agg(F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("left"),
                 F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right")),
            f"kmr-pairs{level}")
        names = _names(pairs, ["left", "right"], f"kmr-names{level + 1}")
        named = pairs.join(names, ["left", "right"]).select(*keys, "i", "name")
        top //= 2
        level += 1
    return named.select(*keys, F.col("name").alias("root")).distinct()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = 4096, probe_bytes: int = 64) -> DataFrame:
    """Group equal texts; of each group the row with the largest id stays.

    Returns one row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256``.

    Defined cases: a null text counts as empty, and all empty texts are one
    group. A null id is smaller than any other; a group of null ids only keeps
    one of its rows with ``keep_id`` null. Rows repeated with the same id and
    text all count in ``group_size`` and exactly one of them is kept. The same
    id with different texts is treated as different documents. An empty table
    gives an empty result. Extra columns are ignored.
    """
    text = empty_text(text_col)
    raw = F.encode(text, "utf-8")
    rows = docs.select(F.col(id_col).alias("doc_id"), raw.alias("_b"), F.sha2(raw, 256).alias("text_sha256"))
    keys = ["doc_id", "text_sha256"]
    base = materialize(rows.select(
        *keys, F.octet_length("_b").cast("long").alias("n_bytes"),
        F.substring("_b", 1, probe_bytes).alias("head"),
        F.expr(f"substring(_b, -{probe_bytes}, {probe_bytes})").alias("tail"),
        F.monotonically_increasing_id().alias("row")), "dedup-base")     # written once: a row keeps its number
    probe = ["n_bytes", "head", "tail"]
    # written first: a plain right side lets adaptive execution split a hot class
    shared = materialize(base.groupBy(*probe).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "dedup-shared")
    flagged = materialize(base.join(shared, probe, "left")
                          .select(*keys, "n_bytes", "row", F.col("n").isNotNull().alias("multi")), "dedup-flag")
    cand = flagged.filter("multi").groupBy(*keys, "n_bytes").agg(F.count(F.lit(1)).alias("copies"),
                                                                 F.min("row").alias("first_row"))
    texts = left_lookup(rows.filter(F.octet_length("_b") > 0), cand.filter("n_bytes > 0").select(*keys),
                        keys, "left_semi")
    roots = block_identity(texts, keys, "_b", block_bytes)
    named = materialize(left_lookup(cand, roots, keys)
                        .withColumn("root", F.coalesce("root", F.lit(-1))), "dedup-roots")
    ident = ["n_bytes", "root"]
    groups = materialize(named.groupBy(*ident).agg(F.max("doc_id").alias("keep_id"),
                                                   F.sum("copies").alias("group_size")), "dedup-groups")
    # of rows equal in id and text the first one read stands for the group; rows meet one
    # written row a key, so adaptive execution can split a row repeated very often
    of = materialize(named.join(groups, ident).select(*keys, "keep_id", "group_size", "first_row"), "dedup-of")
    dup = left_lookup(flagged.filter("multi"), of, keys).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("row") == F.col("first_row"))).alias("kept"), "text_sha256")
    alone = flagged.filter("NOT multi").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    return alone.unionByName(dup)


ORACLE_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
