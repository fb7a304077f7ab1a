"""Operator 5: substring dedup by seed and extend.

Texts are joined on winnowed anchors (word k-grams): every window of ``length``
words holds one, and equal windows hold the same one. From the anchor, matches
are extended both ways, a word at a time: occurrences that still agree stay in
one class, so a whole group is extended at once and no pair is ever listed. A
window repeats when some other occurrence agrees with it on enough words to the
left and to the right together; overlapping repeats merge into maximal ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichkit.llm.anchors import KEYS, keyed, merged, repeated_spans, span_lists, word_bounds
from enrichkit.llm.common import give_back, left_lookup, mix64

SPACE = re.compile(rb"[\x20\x09-\x0D]+")


def extend_matches(length: int, k: int):
    """``compare`` of the anchored frame: classes by left and right extension."""
    reach = length - k

    def compare(anchor: np.ndarray, cnt: np.ndarray, at: np.ndarray, segs: list[np.ndarray]) -> list[np.ndarray]:
        m = len(segs)
        ctx = np.zeros((m, 2 * reach + k), np.uint64)  # words around the anchor
        n = np.array([len(s) - length + 1 for s in segs])
        for i, s in enumerate(segs):
            ctx[i, reach - at[i]:reach - at[i] + len(s)] = s
        group = mix64(anchor.view(np.uint64))
        left, right = np.empty((reach + 1, m), np.uint64), np.empty((reach + 1, m), np.uint64)
        left[0] = right[0] = group
        for d in range(1, reach + 1):
            left[d] = mix64(left[d - 1] ^ mix64(ctx[:, reach - d] + np.uint64(d)))
            right[d] = mix64(right[d - 1] ^ mix64(ctx[:, reach + k + d - 1] + np.uint64(d)))
        first = np.cumsum(n) - n
        marks = np.zeros(int(n.sum()), bool)
        for d in range(reach + 1):  # the window that starts d words before the anchor
            start = at - d
            live = np.flatnonzero((start >= 0) & (start < n))
            both = left[d, live] + mix64(right[reach - d, live])
            live = live[np.argsort(both, kind="stable")]
            key = left[d, live] + mix64(right[reach - d, live])
            words = ctx[live, reach - d:reach - d + length]
            eq = (key[1:] == key[:-1]) & (words[1:] == words[:-1]).all(axis=1)
            hit = live[np.r_[False, eq] | np.r_[eq, False] | (cnt[live] > 1)]
            marks[first[hit] + start[hit]] = True
        return np.split(marks, first[1:])

    return compare


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35,
                    k: int = 8) -> DataFrame:
    """Remove every word covered by a window of ``length`` words that also
    starts anywhere else, the same document included.

    Returns one row per input row: ``doc_id, n_words, n_removed, spans`` (the
    maximal repeats as word ranges, end exclusive) and ``kept`` (the remaining
    words joined by one space). Windows are judged on the input.

    Defined cases: a null or empty text has no words. Null ids are ids like any
    other; rows of one id with different texts are different documents, and
    rows repeated whole are copies of each other. An empty table gives no rows.
    Extra columns are ignored. Texts of any length are read whole.
    """
    if not 1 <= k <= length:
        raise ValueError("k must lie between 1 and the window length")
    texts = keyed(docs, id_col, text_col)
    # a group is compared in a few words' hashes a segment: 16,384 of them take 20 MB
    spans = repeated_spans(texts, "words", length, k, extend_matches(length, k), group_rows=1 << 14,
                           batch_bytes=1 << 20)
    joined = left_lookup(texts, spans, KEYS).select("doc_id", "text", "spans")
    id_type = docs.select(F.col(id_col)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, gone, runs, kept = [], [], [], []
            for t, s in zip(b.column(1), b.column(2), strict=True):
                raw = t.as_py()
                start, end = merged(s)
                first, last = word_bounds(np.frombuffer(raw, np.uint8))
                total.append(len(first))
                gone.append(int((end - start).sum()))
                runs.append((start, end))
                # what stands between the removed ranges, its white space as one space
                stay = zip(np.r_[0, end].tolist(), np.r_[start, len(first)].tolist(), strict=True)
                kept.append(b" ".join([SPACE.sub(b" ", raw[first[a]:last[z - 1]]) for a, z in stay if z > a]))
            yield pa.record_batch([b.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                                   span_lists(runs), pa.array(kept, pa.binary())],
                                  names=["doc_id", "n_words", "n_removed", "spans", "kept"])
            give_back()

    out = joined.mapInArrow(run, f"doc_id {id_type}, n_words long, n_removed long, "
                                 "spans array<struct<start:long,end:long>>, kept binary")
    return out.withColumn("kept", F.decode("kept", "utf-8"))


def plain_removed(texts: list[str], length: int) -> list[np.ndarray]:
    """Brute force, for tests: removed words of every text."""
    from collections import Counter
    words = [t.encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        hit = np.zeros(len(w), bool)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                hit[i:i + length] = True
        out.append(hit)
    return out
