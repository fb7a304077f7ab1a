"""Operator 4: SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints within ``radius`` bits are found by splitting the 64 bits into
parts, correlated bits together, and giving part i its own threshold t_i with
sum(t_i) = radius - parts + 1 (a threshold of -1 skips a part): any linked pair
is within t_i on some part. How many parts there are and their thresholds come
from a dynamic program over estimated probe rows and candidate pairs. Buckets
are probed with the part's masked values and verified by whole distance;
buckets that are too full are split again over the bits not yet fixed, which is
the same principle once more, so the result stays exact.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichkit.llm.common import components, left_lookup, materialize

SEED = 42


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the lower-cased (A-Z) words' shingles."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False)))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(grams), 65536):
        some = grams[at:at + 65536]
        digests = b"".join(map(xxhash.xxh64_digest, some, itertools.repeat(SEED)))
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(grams)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``doc_id, th, fp`` (signed 64-bit) of every row; ``th`` is a text hash."""
    raw = F.col(text_col).cast("binary")
    src = docs.select(F.col(id_col).alias("doc_id"), raw.alias("text"), F.xxhash64(raw).alias("th"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py() or b"", shingle) for t in b.column(1)], np.uint64)
            yield pa.record_batch([b.column(0), b.column(2), pa.array(fps.view(np.int64))],
                                  names=["doc_id", "th", "fp"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, th long, fp long")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, P(bit = 1), 64 x 64 correlations) over all distinct fingerprints;
    only 4096 sums reach the driver."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((64, 64)), 0
        for b in batches:
            bits = _bits(b.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            both += bits.T @ bits
            n += len(bits)
        if n:
            yield pa.record_batch([pa.array(np.arange(4097)), pa.array(np.append(both.ravel(), n))],
                                  names=["k", "v"])

    got = dict(fps.select("fp").mapInArrow(sums, "k long, v double").groupBy("k").agg(F.sum("v").alias("v"))
               .collect())
    n = int(got.get(4096, 0))
    if not n:
        return 0, np.full(64, 0.5), np.eye(64)
    both = np.array([got[k] for k in range(4096)]).reshape(64, 64) / n
    p = np.diag(both).copy()
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return n, p, (both - np.outer(p, p)) / np.outer(sd, sd)


def _bits(values: np.ndarray) -> np.ndarray:
    """Row per value, column j is bit j (least significant first)."""
    return np.unpackbits(np.ascontiguousarray(values.astype(np.int64)).view(np.uint8).reshape(-1, 8),
                         axis=1, bitorder="little")


def group_bits(corr: np.ndarray, bits: list[int], parts: int) -> list[list[int]]:
    """Split bits into near-equal parts, most correlated bits together."""
    left, out = list(bits), []
    strength = np.abs(corr) - np.eye(len(corr))
    for i in range(parts):
        width = (len(left) + parts - i - 1) // (parts - i)
        first = max(left, key=lambda b: (strength[b, left].sum(), -b))
        part = [first]
        left.remove(first)
        while len(part) < width:
            nxt = max(left, key=lambda b: (strength[b, part].mean(), -b))
            part.append(nxt)
            left.remove(nxt)
        out.append(sorted(part))
    return out


def near_share(p: np.ndarray, part: list[int], within: int) -> float:
    """P(distance <= within) / P(distance = 0) on a part, bits taken as
    independent: scales the measured number of equal pairs."""
    dist = np.array([1.0])
    for b in part:
        q = min(max(2 * p[b] * (1 - p[b]), 1e-9), 1 - 1e-9)
        dist = np.convolve(dist, [1 - q, q])
    return float(dist[:within + 1].sum() / dist[0])


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds with the given sum and the least summed cost (DP over parts)."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t, extra in cost.items():
                cand = (c + extra, [*ts, t])
                if used + t not in nxt or cand[0] < nxt[used + t][0]:
                    nxt[used + t] = cand
        best = nxt
    return best.get(total, (math.inf, []))


def choose_plan(fps: DataFrame, radius: int) -> list[tuple[list[int], int]]:
    """Parts of bits with their thresholds, by least estimated cost."""
    n, p, corr = bit_statistics(fps)
    options = {m: group_bits(corr, list(range(64)), m) for m in range(1, radius + 2)}
    if not n:  # nothing to estimate from
        return [(part, 0) for part in options[radius + 1]]
    keys = F.array(*[F.struct(F.lit(100 * m + i).alias("part"), _project("fp", part).alias("key"))
                     for m, parts in options.items() for i, part in enumerate(parts)])
    pair = F.col("c") * (F.col("c") - 1) / 2
    equal = dict(fps.select(F.explode(keys).alias("k")).groupBy("k.part", "k.key")
                 .agg(F.count(F.lit(1)).alias("c")).groupBy("part").agg(F.sum(pair).alias("pairs")).collect())
    best: tuple[float, list[tuple[list[int], int]]] = (math.inf, [])
    for m, parts in options.items():
        costs = []
        for i, part in enumerate(parts):
            cost = {-1: 0.0}
            for t in range(radius + 1):
                rows = n * math.comb(len(part), t)
                pairs = equal.get(100 * m + i, 0.0) * near_share(p, part, t)
                cost[t] = 20.0 * rows + pairs  # a shuffled row weighs about 20 comparisons
            costs.append(cost)
        total, ts = allocate(costs, radius - m + 1)
        if total < best[0]:
            best = (total, list(zip(parts, ts, strict=True)))
    return best[1] or [(part, 0) for part in options[radius + 1]]


def _project(col: str, bits: list[int]):
    """The value masked to some bits: two values agree on the bits exactly
    when the masked values are equal."""
    mask = sum(1 << b for b in bits)
    return F.col(col).bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask))


def probes(fps: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """``sig, fixed, key, fp``: a part with threshold t is probed under every
    choice of t masked bits. ``fixed`` has the bits that the key settles."""
    structs = []
    for i, (part, t) in enumerate(plan):
        if t < 0:
            continue
        for j, drop in enumerate(itertools.combinations(part, t)):
            rest = [b for b in part if b not in drop]
            mask = sum(1 << b for b in rest)
            mask = mask - (1 << 64) if mask >= 1 << 63 else mask
            structs.append(F.struct(F.lit(f"{i}.{j}").alias("sig"), F.lit(mask).cast("long").alias("fixed"),
                                    _project("fp", rest).alias("key")))
    return fps.select("fp", F.explode(F.array(*structs)).alias("s")).select("s.sig", "s.fixed", "s.key", "fp")


def _refine(hot: DataFrame, radius: int) -> DataFrame:
    """Split full buckets over the bits that are not yet fixed: the pair is
    within the radius there too, so some of radius + 1 pieces is equal."""
    schema = "sig string, fixed long, key long, fp long"
    pieces = radius + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = b.column(0).to_pylist()
            fixed = b.column(1).to_numpy(zero_copy_only=False)
            fp = b.column(3).to_numpy(zero_copy_only=False)
            for piece in range(pieces):
                masks = {int(f): _piece_mask(int(f), piece, pieces) for f in np.unique(fixed)}
                more = np.array([masks[int(f)] for f in fixed], np.int64)
                now = fixed | more
                yield pa.record_batch([
                    pa.array([f"{s}/{piece}" for s in sig]), pa.array(now), pa.array(fp & now), pa.array(fp)],
                    names=["sig", "fixed", "key", "fp"])

    return hot.select("sig", "fixed", "key", "fp").mapInArrow(run, schema)


def _piece_mask(fixed: int, piece: int, pieces: int) -> int:
    open_bits = [b for b in range(64) if not (fixed >> b) & 1]
    mask = sum(1 << b for b in open_bits[piece::pieces])
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _links(group: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links within one bucket."""
    out, open_ = [], group
    while len(open_) > 1:
        stack, open_ = [open_[0]], open_[1:]
        while stack and len(open_):
            v = stack.pop()
            near = np.bitwise_count((open_ ^ v).view(np.uint64)) <= radius
            if near.any():
                hit = open_[near]
                out.extend((int(v), int(h)) for h in hit)
                stack.extend(hit)
                open_ = open_[~near]
    return out


def _verify(rows: DataFrame, radius: int) -> DataFrame:
    """Links inside buckets of bounded size, each bucket whole in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, np.ndarray] | None = None
        for b in itertools.chain(batches, [None]):
            if b is not None:
                sig = b.column(0).to_numpy(zero_copy_only=False)
                fp = b.column(1).to_numpy(zero_copy_only=False)
                if held is not None:
                    sig, fp = np.concatenate([held[0], sig]), np.concatenate([held[1], fp])
                if not len(fp):
                    continue
                last = np.flatnonzero(sig != sig[-1])
                cut = int(last[-1]) + 1 if len(last) else 0
                held = (sig[cut:], fp[cut:])
                sig, fp = sig[:cut], fp[:cut]
            elif held is not None:
                sig, fp = held
            else:
                continue
            edges: list[tuple[int, int]] = []
            starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.array([], int)
            ends = np.r_[starts[1:], len(sig)] if len(sig) else starts
            size = ends - starts
            two = starts[size == 2]
            near = np.bitwise_count((fp[two] ^ fp[two + 1]).view(np.uint64)) <= radius
            edges.extend(zip(fp[two[near]].tolist(), fp[two[near] + 1].tolist(), strict=True))
            for s, e in zip(starts[size > 2].tolist(), ends[size > 2].tolist(), strict=True):
                edges.extend(_links(fp[s:e], radius))
            if edges:
                a, c = zip(*edges, strict=True)
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(c, pa.int64())], names=["a", "b"])

    bucket = F.xxhash64("sig", "key").alias("bucket")
    ordered = rows.select(bucket, "fp").repartition("bucket").sortWithinPartitions("bucket", "fp")
    return ordered.mapInArrow(run, "a long, b long")


def link_fingerprints(fps: DataFrame, radius: int, bucket_rows: int = 2048) -> DataFrame:
    """Edges ``a, b`` that connect all distinct fingerprints within ``radius``."""
    rows, edges = probes(fps, choose_plan(fps, radius)), None
    depth = 0
    while True:
        rows = materialize(rows, f"gph-rows{depth}")
        sizes = materialize(rows.groupBy("sig", "key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"),
                            f"gph-sizes{depth}")
        sized = materialize(rows.join(sizes, ["sig", "key"]), f"gph-sized{depth}")
        full = (F.col("c") > bucket_rows) & (F.bit_count("fixed") < 64)
        found = _verify(sized.filter(~full), radius)
        found = materialize(found.distinct(), f"gph-links{depth}")
        edges = found if edges is None else edges.unionByName(found)
        hot = sized.filter(full)
        if hot.isEmpty():
            return edges
        rows = _refine(hot, radius)
        depth += 1


def simhash_near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       radius: int = 3) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document.

    Returns one row per input row: ``doc_id, fingerprint`` (16 lower-case hex
    digits), ``component_id``, the smallest id reachable over links of at most
    ``radius`` differing bits, the row itself included, ``th`` (64-bit hash of
    the text) and ``label`` (the same for all rows of a component).

    Defined cases: a null or word-less text has fingerprint zero and links like
    any other; fewer words than a shingle are one shingle. Null ids take part
    in links; ``component_id`` ignores them and is null only when all ids of the
    component are. Repeated rows are equal documents. An empty table gives no
    rows. Extra columns are ignored. Texts are read whole.
    """
    sigs = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash")
    fps = materialize(sigs.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    labels = components(link_fingerprints(fps.select("fp"), radius))
    named = fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("label", F.coalesce("label", "fp"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    of = materialize(named.join(least, "label").select("fp", "component_id", "label"), "simhash-of")
    return left_lookup(sigs, of, ["fp"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "th", "label")
