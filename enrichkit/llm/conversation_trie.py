"""Operator 12: prefix trie of conversations as balanced parentheses.

Conversations that start with the same turns share a path of a trie. Their turn
sequences are sorted, cut into shards of a bounded number of turns, and each
shard's part of the trie is written as balanced parentheses: a node opens, its
children follow, it closes. A tree of block minima over the excess (range
min-max) finds the closing parenthesis of every node, which delimits its subtree;
ranks over the parentheses count its leaf pairs, and cumulative arrays over its
opening parentheses give its conversations and savings.

Neighbouring shards share the nodes of a spine: the path to the last sequence of
the one, so far as the first of the other begins the same. A shard is told the
sequence before it, so it knows which of these nodes are not its own; every
figure then is a sum over shards, and spines merge by one aggregate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from enrichkit.llm.common import give_back, materialize
from enrichkit.llm.spelling import CRC_TABLE_SQL, crc_sql

#: Bytes of a turn's symbol: 16 of a digest of role and text, 4 of the text's length.
SYMBOL = 20
#: Ids in a piece of one sequence's members.
PIECE = 8192
_BLOCK = 64
NOTHING = hashlib.sha256(b"").hexdigest()


def symbol(role: Column, text: Column) -> Column:
    """Hexadecimal symbol of a turn: equal exactly when role and text are."""
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return F.concat(F.substring(digest, 1, 32), F.lpad(F.lower(F.hex(F.octet_length(text).cast("long"))), 8, "0"))


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """``conv_id, symbols``: the symbols of each conversation by turn, null first;
    turns of one number by their symbols."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), symbol(blank(role_col), blank(text_col)).alias("symbol")).alias("t"))
    ordered = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(ordered.alias("t")).select("conv_id", F.col("t.symbol").alias("symbols"))


def rebuilt(seqs: DataFrame, family: int = 5, modulus: int = 9) -> DataFrame:
    """``conv_id, symbols`` with each start replaced: the first h turns of the
    conversation ``c - c % family`` and then one's own behind its first h, for
    h = crc32(c) % ``modulus``."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus).cast("int")
    own = seqs.withColumn("h", h).withColumn("of", F.col("conv_id") - F.col("conv_id") % family)
    base = seqs.select(F.col("conv_id").alias("of"), F.col("symbols").alias("first"))
    head = F.slice(F.coalesce("first", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    tail = F.slice("symbols", F.col("h") + 1, F.size("symbols"))
    return own.join(base, "of", "left").select("conv_id", F.concat(head, tail).alias("symbols"))


def members(convs: DataFrame, piece_ids: int = PIECE) -> DataFrame:
    """``key, n, least, ends``: every distinct sequence (its symbols as bytes)
    with how many conversations have it, the smallest id of these, and the SHA-256
    of their ids. The rows are sorted by sequence and id over all partitions, so
    a sequence that many conversations have is spread; each partition joins its
    ids into pieces, and only the pieces of a sequence meet in one task, where the
    digest runs through them."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        for b in batches:
            out = []
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if ids and (k != key or len(ids) == piece_ids):
                    out.append((key, ids[0], len(ids), ",".join(map(str, ids))))
                    ids = []
                key = k
                ids.append(c)
            if out:
                yield _batch(out, piece)
        if ids:
            yield _batch([(key, ids[0], len(ids), ",".join(map(str, ids)))], piece)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, least, run = None, 0, 0, None
        for b in batches:
            out = []
            for k, first, some, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if run is not None and k != key:
                    out.append((key, n, least, run.hexdigest()))
                    run = None
                if run is None:
                    key, n, least, run = k, 0, first, hashlib.sha256()
                else:
                    run.update(b",")
                n += some
                run.update(text.encode())
            if out:
                yield _batch(out, whole)
        if run is not None:
            yield _batch([(key, n, least, run.hexdigest())], whole)

    piece = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])
    whole = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("least", pa.int64()), ("ends", pa.string())])
    rows = convs.select(F.unhex(F.array_join("symbols", "")).alias("key"), "conv_id")
    rows = materialize(rows, "trie-rows")
    ordered = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    some = materialize(ordered.mapInArrow(pieces, "key binary, first long, n long, ids string"), "trie-pieces")
    met = some.repartition("key").sortWithinPartitions("key", "first")
    return materialize(met.mapInArrow(digests, "key binary, n long, least long, ends string"), "trie-members")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def shards(seqs: DataFrame, shard_turns: int) -> DataFrame:
    """``shard, start, before, key, n, least, ends``: the sequences in order, cut
    into shards by their running number of turns (a root counts as one); the last
    sequence of a shard is told to the next one too (``before``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for b in batches:
            size = np.array([len(k.as_buffer()) // SYMBOL + 1 for k in b.column(0)], np.int64)
            end = np.cumsum(size) + total
            yield pa.record_batch([pa.array(np.full(len(size), part)), pa.array(end - size), pa.array(size), *b.columns],
                                  names=["part", "at", "size", "key", "n", "least", "ends"])
            total = int(end[-1]) if len(size) else total

    ordered = seqs.repartitionByRange("key").sortWithinPartitions("key")
    rows = materialize(ordered.mapInArrow(run, "part long, at long, size long, key binary, n long, least long, ends string"),
                       "trie-order")
    per = rows.groupBy("part").agg(F.sum("size").alias("sum"))  # one row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = per.select("part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset"))
    start = F.col("at") + F.col("offset")
    placed = rows.join(F.broadcast(offset), "part").withColumn("start", start)
    own = F.floor(F.col("start") / shard_turns)
    following = F.floor((F.col("start") + F.col("size")) / shard_turns)
    places = F.array_compact(F.array(F.struct(own.alias("shard"), F.lit(False).alias("before")),
                                     F.when(following > own, F.struct(following.alias("shard"), F.lit(True).alias("before")))))
    return placed.select(F.inline(places), "start", "key", "n", "least", "ends")


def find_close(excess: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For opening parentheses at places ``at``, where each closes: the first
    place behind it with a lesser excess. Blocks of 64 places know their least
    excess, and so do pairs of blocks, pairs of these and so on."""
    n = len(excess)
    blocks = -(-n // _BLOCK)
    padded = np.full(blocks * _BLOCK, np.iinfo(excess.dtype).min, excess.dtype)
    padded[:n] = excess
    level = [padded.reshape(blocks, _BLOCK).min(axis=1)]
    while len(level[-1]) > 1:
        last = level[-1]
        if len(last) % 2:
            last = np.append(last, np.iinfo(excess.dtype).max)
        level.append(np.minimum(last[::2], last[1::2]))
    goal = excess[at] - 1
    out = np.full(len(at), -1, np.int64)

    def scan(rows: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Look from ``place`` to the end of its block; the rows not found."""
        while len(rows):
            hit = padded[place] <= goal[rows]
            out[rows[hit]] = place[hit]
            go = ~hit & ((place + 1) % _BLOCK != 0)
            if not go.any():
                return rows[~hit]
            if (~hit & ~go).any():
                rest = rows[~hit & ~go]
                return np.concatenate([rest, scan(rows[go], place[go] + 1)])
            rows, place = rows[go], place[go] + 1
        return rows

    inner = (at + 1) % _BLOCK != 0
    open_ = np.concatenate([np.flatnonzero(~inner), scan(np.flatnonzero(inner), at[inner] + 1)])
    node, up = at[open_] // _BLOCK, np.zeros(len(open_), np.int64)
    climbing = np.arange(len(open_))
    for k in range(len(level)):           # up, until the right sibling holds a lesser excess
        sibling = node[climbing] + 1
        ok = (node[climbing] % 2 == 0) & (sibling < len(level[k]))
        ok[ok] = level[k][sibling[ok]] <= goal[open_[climbing[ok]]]
        node[climbing[ok]] += 1
        up[climbing[ok]] = k
        climbing = climbing[~ok]
        node[climbing] //= 2
    for k in range(len(level) - 1, 0, -1):  # and down to the leftmost such block
        down = np.flatnonzero(up == k)
        child = 2 * node[down]
        right = level[k - 1][child] > goal[open_[down]]
        node[down] = child + right
        up[down] = k - 1
    scan(open_, node * _BLOCK)
    return out


def common_turns(a: bytes, b: bytes) -> int:
    """How many symbols two sequences share from the start."""
    most = min(len(a), len(b)) // SYMBOL
    if a[:SYMBOL * most] == b[:SYMBOL * most]:
        return most
    lo, hi = 0, most - 1                   # the first lo symbols agree, the first hi + 1 do not
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[:SYMBOL * mid] == b[:SYMBOL * mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def text_bytes(key: bytes) -> np.ndarray:
    """The text lengths in a sequence's symbols."""
    return np.frombuffer(key, np.uint8).reshape(-1, SYMBOL)[:, 16:].copy().view(">u4")[:, 0]


def _path_ids(key: bytes, depth: int) -> list[bytes]:
    """Names of the nodes at depths 0 to ``depth`` on a sequence's path."""
    run, out = hashlib.sha256(), []
    for d in range(depth + 1):
        run.update(key[SYMBOL * (d - 1):SYMBOL * d] if d else b"")
        out.append(run.digest()[:16])
    return out


NODE = pa.schema([("nid", pa.binary()), ("pid", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
                  ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                  ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())])


def shard_nodes(before: bytes | None, keys: list[bytes], n: np.ndarray, least: np.ndarray, ends: list[str]) -> pa.Table:
    """The nodes of one shard's trie. Nodes that other shards may have too (the
    spine) have a name ``nid``, and their figures are this shard's share; nodes
    below a spine node have its name as ``pid`` in place of a parent's id."""
    turns = np.array([len(k) // SYMBOL for k in keys])
    shared = np.array([common_turns(a, b) for a, b in zip([before or b"", *keys[:-1]], keys, strict=True)])
    old = int(shared[0]) + 1 if before is not None else 0       # opening parentheses of earlier shards' nodes
    # runs of parentheses: the shared start, then what closes before and opens for each sequence
    opens = turns - shared
    opens[0] += 0 if before is not None else 1                  # the root
    runs = np.zeros(2 * len(keys) + 2, np.int64)
    runs[0], runs[2:-1:2] = old, opens
    runs[3:-1:2] = turns[:-1] - shared[1:]
    runs[-1] = turns[-1] + 1
    up = np.repeat(np.arange(len(runs)) % 2 == 0, runs)
    excess = np.cumsum(np.where(up, 1, -1)).astype(np.int32)
    at = np.flatnonzero(up)
    close = find_close(excess, at)
    rank = np.concatenate([[0], np.cumsum(up)])                 # opening parentheses before a place
    end = rank[close]                                           # a subtree's opening parentheses are node..end-1
    depth = excess[at].astype(np.int64) - 1
    leaf = up & ~np.append(up[1:], False)
    leaves = np.concatenate([[0], np.cumsum(leaf)])
    n_leaves = leaves[close] - leaves[at]
    if before is not None and common_turns(before, keys[0]) * SYMBOL == len(before):
        n_leaves[:old] -= 1                                     # the sequence before was a leaf so far
    last = old + np.cumsum(opens) - 1                           # each sequence's own node
    here = np.zeros(len(at) + 1, np.int64)
    here[last + 1] = n
    total = np.cumsum(here)
    n_convs = total[end] - total[:-1]
    first = np.searchsorted(last, np.arange(len(at)))
    to = np.searchsorted(last, end)
    smallest = np.minimum.reduceat(np.append(least, np.iinfo(np.int64).max), np.stack([first, to], 1).ravel())[::2]
    # the last text's bytes of every node, and its parent, along the current path
    size, parent = np.zeros(len(at), np.int64), np.full(len(at), -1, np.int64)
    path = list(range(old))
    size[1:old] = text_bytes(keys[0])[:max(old - 1, 0)]
    parent[1:old] = np.arange(max(old - 1, 0))
    new = old
    for i, k in enumerate(keys):
        some = int(opens[i])
        stay = len(path) if i == 0 else int(shared[i]) + 1
        del path[stay:]
        parent[new:new + some] = np.arange(new - 1, new + some - 1)
        parent[new] = path[-1] if path else -1
        lengths = text_bytes(k[SYMBOL * max(stay - 1, 0):])
        size[new + some - len(lengths):new + some] = lengths
        path.extend(range(new, new + some))
        new += some
    fresh = np.arange(len(at)) >= old
    value = np.concatenate([[0], np.cumsum((n_convs - fresh) * size)])
    saved = value[end] - value[:-1]
    children = np.bincount(parent[fresh & (parent >= 0)], minlength=len(at))
    name = np.full(len(at), None, object)
    for node, nid in zip(range(old), _path_ids(keys[0], max(old - 1, 0)), strict=False):
        name[node] = nid
    for node, nid in zip(path, _path_ids(keys[-1], int(turns[-1])), strict=True):
        name[node] = nid
    above = np.append(name, None)[parent]
    known = np.append(smallest, 0)[parent]
    hide = (parent < 0) | np.array([x is not None for x in above])
    digest = np.full(len(at), None, object)
    digest[last] = ends
    return pa.table([pa.array(name, pa.binary()), pa.array(above, pa.binary()), pa.array(smallest), pa.array(depth),
                     pa.array(known, mask=hide), pa.array(n_convs), pa.array(children), pa.array(n_leaves),
                     pa.array(saved), pa.array(digest, pa.string())], schema=NODE)


def trie_nodes(placed: DataFrame) -> DataFrame:
    """``shard_nodes`` of every shard, a shard at a time in a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[0] != shard:
                    yield from _shard(rows)
                    shard, rows = row[0], []
                rows.append(row[1:])
        yield from _shard(rows)
        give_back()

    ordered = placed.select("shard", "before", "start", "key", "n", "least", "ends") \
        .repartition("shard").sortWithinPartitions("shard", "start")
    return ordered.mapInArrow(run, "nid binary, pid binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
                                   "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")


def _shard(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    before = [r[2] for r in rows if r[0]]
    mine = [r[2:] for r in rows if not r[0]]
    if mine:
        keys, n, least, ends = zip(*mine, strict=True)
        yield from shard_nodes(before[-1] if before else None, list(keys), np.array(n), np.array(least), list(ends)
                               ).to_batches(max_chunksize=1 << 14)


def conversation_trie(turns: DataFrame, rebuild: bool = False, shard_turns: int = 1 << 15, piece_ids: int = PIECE,
                      **columns: str) -> DataFrame:
    """The prefix trie of conversations (``conv_id, turn, role, text``), one row a
    node: ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``.

    A node is a distinct sequence of first turns, the root the empty one. With
    ``rebuild``, conversations are first rebuilt (see ``rebuilt``). ``saved_tokens``
    sums (n_convs - 1) times the UTF-8 bytes of the last text over the subtree;
    ``ends_sha256`` is the digest of the ids that end at the node, ascending.

    Defined cases: null roles and texts are empty ones; turns are ordered by
    number, null first, and turns of one number (repeated rows too, each counts) by
    a digest of role and text. Rows without a conversation id belong to no
    conversation and are left out. An empty table gives no rows. Extra columns
    are ignored. Texts of any length are hashed whole, where they are read; a
    conversation is 20 bytes a turn from there on.
    """
    seqs = materialize(sequences(turns, **columns), "trie-sequences")
    convs = rebuilt(seqs) if rebuild else seqs
    nodes = materialize(trie_nodes(shards(members(convs, piece_ids), shard_turns)), "trie-nodes")
    figures = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    spine = nodes.filter("nid is not null").groupBy("nid").agg(
        F.max("pid").alias("pid"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in figures], F.max("ends_sha256").alias("ends_sha256"))
    spine = materialize(spine, "trie-spine")
    name = spine.select(F.col("nid").alias("pid"), F.col("conv_id").alias("parent_conv_id"))
    out = ["conv_id", "depth", "parent_conv_id", *figures, "ends_sha256"]
    inner = nodes.filter("nid is null")
    below = inner.filter("pid is not null").drop("parent_conv_id").join(name, "pid")
    merged = spine.join(name, "pid", "left")
    rows = inner.filter("pid is null").select(*out).unionByName(below.select(*out)).unionByName(merged.select(*out))
    return rows.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))


#: The same rows in DuckDB: turns as numbers, nodes as lists of them.
ORACLE_SQL = f"""
WITH {CRC_TABLE_SQL},
turn0 AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT *, dense_rank() OVER (ORDER BY r, t) AS id,
                 sha256(concat(strlen(r)::VARCHAR, ':', r, t)) AS digest FROM turn0),
sizes AS (SELECT DISTINCT id, strlen(t)::BIGINT AS bytes FROM turns),
seqs AS (SELECT conv_id, list(id ORDER BY turn NULLS FIRST, digest) AS s FROM turns GROUP BY conv_id),
cut AS (SELECT conv_id, s, {crc_sql("conv_id::VARCHAR")} % 9 AS h FROM seqs, crc),
convs AS (SELECT a.conv_id AS c, list_concat(coalesce(b.s[:h], []), a.s[h + 1:]) AS s
          FROM cut a LEFT JOIN seqs b ON b.conv_id = a.conv_id - a.conv_id % 5),
starts AS (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM convs),
nodes AS (SELECT s[:d] AS k, d, min(c) AS conv_id, count(*) AS n_convs FROM starts GROUP BY ALL),
sized AS (SELECT k, d, conv_id, n_convs, coalesce(bytes, 0) AS bytes FROM nodes LEFT JOIN sizes ON k[d] = id),
kids AS (SELECT k[:d - 1] AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
full_ AS (SELECT sized.*, coalesce(n_children, 0) AS n_children FROM sized LEFT JOIN kids USING (k)),
up AS (SELECT k[:a] AS k, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
       FROM (SELECT *, unnest(range(d + 1)) AS a FROM full_) GROUP BY ALL),
ends AS (SELECT s AS k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256 FROM convs GROUP BY s)
SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens,
       coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM full_ f JOIN up USING (k) LEFT JOIN ends USING (k) LEFT JOIN nodes p ON f.d > 0 AND p.k = f.k[:f.d - 1]"""
