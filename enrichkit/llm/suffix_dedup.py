"""Operator 3: repeated byte strings by column-wise suffix sorting of many texts.

The collection's Burrows-Wheeler transform is built a column at a time: round j
puts the j-th symbol from the right of every text in front of the suffix
inserted the round before. Its place follows from the transform so far (equal
first symbols keep the order of what they precede), and the common prefix with
each neighbour is one more than the least common prefix between what follows
their first symbols. Each round reads the round before from front to back and
writes the next, no suffix is ever compared as a string.

A symbol is a block of bytes that divides the passage length (40 for 400), named
in byte order; a text is entered once per block phase. So a passage of 400 bytes
is 10 equal symbols and a collection needs a fortieth of the rounds. Collections are the groups of ``anchors``: segments of bounded length
(under two passages) that share an anchor, written as one table in the shared
folder and read group after group, so rounds and memory stay bounded at any
corpus size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichkit.llm.anchors import KEYS, keyed, merged, repeated_spans, span_lists
from enrichkit.llm.common import give_back, left_lookup

_TILE = 64


def block_size(length: int) -> tuple[int, int]:
    """(bytes in a base block, base blocks in a symbol): a base block has up to
    8 bytes, a symbol up to 5 base blocks, and symbols divide the length."""
    g = max(x for x in range(1, 9) if length % x == 0)
    return g, max(m for m in range(1, 6) if length // g % m == 0)


def symbol_names(value: np.ndarray, g: int, m: int, room: np.ndarray) -> np.ndarray:
    """Integer names, in byte order, of the ``m`` base blocks that start at each
    place: names of halves are sorted as pairs. Places without room get -1."""
    have: dict[int, np.ndarray] = {}

    def name(blocks: int) -> np.ndarray:
        if blocks not in have:
            fits = np.flatnonzero(room >= blocks * g)
            if blocks == 1:
                key = value[fits]
            else:
                half = 1 << (blocks - 1).bit_length() - 1
                left, right = name(half), name(blocks - half)
                key = left[fits] * np.int64(len(value) + 1) + right[fits + half * g]
            out = np.full(len(value), -1, np.int32)
            out[fits] = np.unique(key, return_inverse=True)[1]
            have[blocks] = out
        return have[blocks]

    return name(m)


def range_minima(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(values[lo..hi]) for many ranges (inclusive), by tiles of 64."""
    tiles = -(-len(values) // _TILE)
    padded = np.full(tiles * _TILE, np.iinfo(values.dtype).max, values.dtype)
    padded[:len(values)] = values
    grid = padded.reshape(tiles, _TILE)
    a, b = lo // _TILE, hi // _TILE
    out = np.empty(len(lo), values.dtype)
    near = np.flatnonzero(a == b)
    if len(near):
        cell = np.minimum(lo[near, None] + np.arange(_TILE), hi[near, None])
        out[near] = padded[cell].min(axis=1)
    far = np.flatnonzero(a != b)
    if len(far):
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        got = np.minimum(behind[lo[far]], ahead[hi[far]])
        span = b[far] - a[far] - 1
        level = [grid.min(axis=1)]
        while 2 << (len(level) - 1) <= max(int(span.max()), 1):
            half = 1 << (len(level) - 1)
            level.append(np.minimum(level[-1][:-half], level[-1][half:]))
        for j in np.flatnonzero(np.bincount(np.frexp(np.maximum(span, 1))[1] - 1, minlength=1)):
            pick = np.flatnonzero((span > 0) & (np.frexp(np.maximum(span, 1))[1] - 1 == j))
            x, y = a[far[pick]] + 1, b[far[pick]] - (1 << int(j))
            got[pick] = np.minimum(got[pick], np.minimum(level[j][x], level[j][y]))
        out[far] = got
    return out


def collection_bwt(symbol: np.ndarray, after: np.ndarray, rounds: np.ndarray, most: int,
                   ahead: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in sorted order, common prefix of each with the one before).

    Suffix i starts with ``symbol[i]`` and goes on with suffix ``after[i]`` (-1:
    ends), inserted the round before; ``rounds[i]`` is its own round. Common
    prefixes are counted up to ``most``. With ``ahead``, the number of symbols
    still to come in front of each suffix, a text is given up as soon as these
    cannot bring a common prefix to ``most`` any more. That loses none when
    suffixes that may match are inserted in the same round."""
    order = np.argsort(rounds, kind="stable")
    cuts = np.searchsorted(rounds[order], np.arange(int(rounds.max()) + 2 if len(rounds) else 1))
    place = np.full(len(symbol), -1, np.int32)      # where last round's suffixes stand
    first = np.empty(0, np.int32)                   # first symbols, in sorted order
    rest = np.empty(0, np.int32)                    # where the remainder of each stands
    lcp = np.empty(0, np.uint16)
    names = np.empty(0, np.int32)
    for r in range(len(cuts) - 1):
        new = order[cuts[r]:cuts[r + 1]]
        where = np.where(after[new] >= 0, place[after[new]], -1).astype(np.int64)
        live = (where >= 0) | (after[new] < 0)
        new, where = new[live], where[live]
        if not len(new):
            continue
        old_n = len(first)
        key = symbol[new].astype(np.int64) * (old_n + 2) + where + 1
        by = np.argsort(key, kind="stable")
        new, where, key = new[by], where[by], key[by]
        at = np.searchsorted(first.astype(np.int64) * (old_n + 2) + (rest + 1), key) + np.arange(len(new))
        n = old_n + len(new)
        fresh = np.zeros(n, bool)
        fresh[at] = True
        kept = np.flatnonzero(~fresh).astype(np.int32)  # the new place of each old suffix
        f, rem, names2 = np.empty(n, np.int32), np.empty(n, np.int32), np.empty(n, np.int32)
        low = np.zeros(n, np.uint16)
        f[kept], f[at] = first, symbol[new]
        rem[kept], rem[at] = rest, where
        names2[kept], names2[at] = names, new
        low[kept] = lcp
        # common prefixes change at new suffixes and right behind them
        ask = fresh.copy()
        ask[1:] |= fresh[:-1]
        ask[0] = False
        t = np.flatnonzero(ask)
        low[0] = 0
        low[t] = 0
        t = t[f[t] == f[t - 1]]
        low[t] = 1
        x, y = rem[t - 1], rem[t]
        go = np.flatnonzero((x >= 0) & (x < y))
        if len(go):
            low[t[go]] = np.minimum(1 + range_minima(lcp, x[go] + 1, y[go]), most)
        if old_n:
            rem = np.where(rem >= 0, kept[rem], -1).astype(np.int32)
        place[new] = at
        if ahead is not None:
            reach = np.maximum(low[at], np.r_[low, np.uint16(0)][at + 1]) + ahead[new]
            place[new[reach < most]] = -1
        first, rest, lcp, names = f, rem, low, names2
    return names, lcp


def repeated_starts(anchor: np.ndarray, cnt: np.ndarray, at: np.ndarray, segs: list[np.ndarray], length: int
                    ) -> list[np.ndarray]:
    """Which starts of each segment have a passage that some other start (or a
    copy of the segment) has too. Rounds count from the right of the anchor, so
    equal passages are inserted in the same rounds."""
    base, m = block_size(length)
    g = base * m
    size = np.array([len(s) for s in segs])
    first = np.cumsum(size) - size
    flat = np.concatenate(segs)
    value = np.zeros(len(flat), np.uint64)
    for i in range(base):
        value[:len(flat) - i] |= flat[i:].astype(np.uint64) << np.uint64(8 * (base - 1 - i))
    owner = np.repeat(np.arange(len(segs), dtype=np.int32), size)
    inside = np.arange(len(flat), dtype=np.int32) - first[owner].astype(np.int32)
    ahead_of_anchor = inside - at[owner]
    room = size[owner] - inside                       # bytes from here to the segment's end
    suffix = np.flatnonzero(room >= g)
    symbol = symbol_names(value, base, m, room)[suffix]
    number = np.full(len(flat) + g, -1, np.int64)
    number[suffix] = np.arange(len(suffix))
    after = np.where(room[suffix] >= 2 * g, number[suffix + g], -1)
    rounds = (length - ahead_of_anchor[suffix]) // g
    names, lcp = collection_bwt(symbol, after, rounds - rounds.min(), length // g,
                                inside[suffix] // g)
    same = lcp >= length // g
    hit = np.zeros(len(flat), bool)
    hit[suffix[names[same | np.r_[same[1:], False]]]] = True
    hit |= (cnt > 1)[owner] & (room >= length)        # all starts of a copied segment repeat
    return [part[:max(len(part) - length + 1, 0)] for part in np.split(hit, first[1:])]


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                 k: int = 32) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also
    starts anywhere else, the same document included.

    Returns one row per input row: ``doc_id, n_bytes, n_removed, spans`` (the
    maximal removed byte runs, end exclusive) and ``kept`` (binary, the remaining
    bytes). Strings are judged on the input; matches never cross documents.

    Defined cases: a null text counts as empty. Null ids are ids like any other;
    rows of one id with different texts are different documents, and rows
    repeated whole are copies of each other. Texts shorter than ``length`` lose
    nothing. An empty table gives no rows. Extra columns are ignored. Texts of
    any length are read whole. Cuts are by byte, so ``kept`` need not be UTF-8.
    """
    if not 1 <= k <= length:
        raise ValueError("k must lie between 1 and the string length")
    texts = keyed(docs, id_col, text_col)
    spans = repeated_spans(texts, "bytes", length, k,
                           lambda anchor, cnt, at, segs: repeated_starts(anchor, cnt, at, segs, length))
    joined = left_lookup(texts, spans, KEYS).select("doc_id", "text", "spans")
    id_type = docs.select(F.col(id_col)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, gone, runs, kept = [], [], [], []
            for t, s in zip(b.column(1), b.column(2), strict=True):
                raw = t.as_py()
                start, end = merged(s)
                total.append(len(raw))
                gone.append(int((end - start).sum()))
                runs.append((start, end))
                stay = zip(np.r_[0, end].tolist(), np.r_[start, len(raw)].tolist(), strict=True)
                kept.append(b"".join([raw[a:z] for a, z in stay]) if len(start) else raw)
            yield pa.record_batch([b.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                                   span_lists(runs), pa.array(kept, pa.binary())],
                                  names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])
            give_back()

    return joined.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, "
                                  "spans array<struct<start:long,end:long>>, kept binary")


def plain_removed(texts: list[bytes], length: int) -> list[np.ndarray]:
    """Brute force, for tests: removed bytes of every text."""
    from collections import Counter
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        hit = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                hit[i:i + length] = True
        out.append(hit)
    return out
