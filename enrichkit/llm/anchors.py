"""Anchored segments: the shared frame of the two repeated-passage operators.

A passage of ``length`` units (bytes or words) is settled by one anchor inside
it, the leftmost of its ``k``-grams with the smallest hash: equal passages have
equal anchors. Consecutive passage starts with one anchor form a segment, so a
text is a few segments per passage length, and two passages can only be equal
when their segments share the anchor. Segments of an anchor that occurs once
are done; equal segments are collapsed to one with a count (all of their
passages repeat); only different segments of one anchor have to be compared,
and that is what the operators do, each by its own method, in groups of bounded
size. Anchors with more different segments than the bound are split: starts are
cut into slices by their distance to the anchor, all passages of a slice hold
one core of bytes or words at a fixed place, and only segments that agree on the
core can have equal passages there. The slices are groups of their own, and are
split again, down to single passages, while they are too many.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichkit.llm.common import give_back, left_lookup, materialize, mix64, window_hash, window_min

#: Base of the polynomial k-gram hash.
BASE = 0x9E3779B97F4A7C15
_LOW = np.uint64((1 << 20) - 1)
KEYS = ["doc_id", "th"]
#: Units, bytes or characters that one numpy step looks at: temporaries take some
#: 60 bytes each, whatever the length of the text.
BLOCK = 1 << 18
LONG_WORD = 4096


def byte_units(text: bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without ASCII white space)."""
    edges, last = [], False
    for at in range(0, len(data), BLOCK):
        some = data[at:at + BLOCK]
        solid = np.empty(len(some) + 1, np.int8)
        solid[0] = last
        solid[1:] = ~((some == 32) | ((some >= 9) & (some <= 13)))
        edges.append(np.flatnonzero(solid[1:] != solid[:-1]) + at)
        last = bool(solid[-1])
    if last:
        edges.append(np.array([len(data)]))
    edge = np.concatenate(edges) if edges else np.empty(0, np.int64)
    return edge[::2], edge[1::2]


def word_units(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word, over blocks of words of bounded size; a word
    beyond ``LONG_WORD`` bytes is hashed by itself."""
    data = np.frombuffer(text, np.uint8)
    start, end = word_bounds(data)
    size = end - start
    out = np.empty(len(start), np.uint64)
    short = np.flatnonzero(size <= LONG_WORD)
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = xxhash.xxh64_intdigest(data[start[i]:end[i]])
    total = np.cumsum(size[short])
    cuts = np.searchsorted(total, np.arange(0, int(total[-1]) + BLOCK, BLOCK), side="right") if len(short) else []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True) if len(short) else ():
        pick = short[lo:hi]
        if not len(pick):
            continue
        first = np.cumsum(size[pick]) - size[pick]
        place = np.arange(int(size[pick].sum()), dtype=np.int64) - np.repeat(first, size[pick])
        chars = data[np.repeat(start[pick], size[pick]) + place].astype(np.uint64)
        chars += np.uint64(1)
        chars |= place.view(np.uint64) << np.uint64(9)
        out[pick] = mix64(np.add.reduceat(mix64(chars), first))
    return out


UNITS: dict[str, Callable[[bytes], np.ndarray]] = {"bytes": byte_units, "words": word_units}


def segments(units: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first passage start, number of starts, anchor hash) of every segment."""
    n = len(units) - length + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none, none, none.astype(np.uint64)
    w = length - k + 1
    starts, anchors, last = [], [], -1
    for at in range(0, n, BLOCK):  # places fit the low bits of the compared value
        some = units[at:min(at + BLOCK, n) + length - 1].astype(np.uint64)
        some += np.uint64(1)
        grams = mix64(window_hash(some, k, BASE))
        least = window_min((grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64), w)
        where = (least & _LOW).astype(np.int64)
        new = np.flatnonzero(np.r_[where[0] + at != last, where[1:] != where[:-1]])
        starts.append(new + at)
        anchors.append(grams[where[new]])
        last = int(where[-1]) + at
    start = np.concatenate(starts)
    return start, np.diff(np.r_[start, n]), np.concatenate(anchors)


def anchor_places(anchor: np.ndarray, segs: list[np.ndarray], length: int, k: int) -> np.ndarray:
    """Where the anchor lies in each segment: all its passages share it, so it
    is not before the last one's start and within reach of the first."""
    size = np.array([len(s) for s in segs])
    n = size - length + 1
    first = np.cumsum(size) - size
    grams = mix64(window_hash(np.concatenate(segs).astype(np.uint64) + np.uint64(1), k, BASE))
    owner = np.repeat(np.arange(len(segs)), size)[:len(grams)]
    place = np.arange(len(grams)) - first[owner]
    hit = np.flatnonzero((grams == anchor.view(np.uint64)[owner]) & (place >= n[owner] - 1)
                         & (place <= length - k))
    _, lead = np.unique(owner[hit], return_index=True)
    return place[hit[lead]]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, th, text`` (bytes, null as empty); ``th`` tells rows of one id apart."""
    raw = F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary"))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(raw).alias("th"), raw.alias("text"))


def occurrences(texts: DataFrame, unit: str, length: int, k: int) -> DataFrame:
    """``doc_id, th, anchor, seg, start, n`` of every segment of every text."""
    units = UNITS[unit]
    id_type = texts.schema["doc_id"].dataType.simpleString()
    names = [*KEYS, "anchor", "seg", "start", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[list] = [[] for _ in range(5)]
            held = 0
            for i, t in enumerate(b.column(2)):
                u = units(t.as_py())
                start, n, anchor = segments(u, length, k)
                if len(start):
                    end = (start + n + length - 1).tolist()
                    raw = memoryview(np.ascontiguousarray(u)).cast("B")
                    w = u.itemsize
                    seg = [xxhash.xxh64_intdigest(raw[w * s:w * e]) for s, e in zip(start.tolist(), end, strict=True)]
                    for out, col in zip(rows, (np.full(len(start), i), anchor, np.array(seg, np.uint64), start, n),
                                        strict=True):
                        out.append(col)
                    held += len(start)
                if held > 50_000 or (held and i == b.num_rows - 1):
                    at, anchor, seg, start, n = (np.concatenate(c) for c in rows)
                    yield pa.record_batch([b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)),
                                           pa.array(anchor.view(np.int64)), pa.array(seg.view(np.int64)),
                                           pa.array(start), pa.array(n.astype(np.int32))], names=names)
                    rows, held = [[] for _ in range(5)], 0
            give_back()

    return texts.mapInArrow(
        run, f"doc_id {id_type}, th long, anchor long, seg long, start long, n int")


#: A segment to compare: its key, copies, number of starts, the anchor's place in
#: it, its units, and how many different segments share the anchor.
CONTENT = "anchor long, seg long, cnt long, n int, at int, units binary, kinds long"


def contents(texts: DataFrame, wanted: DataFrame, unit: str, length: int, k: int) -> DataFrame:
    """``CONTENT`` rows of the wanted segments, read from the one text that
    represents each (a text carries all of its wanted segments)."""
    units = UNITS[unit]
    per_text = wanted.groupBy(*KEYS).agg(F.collect_list(F.struct("anchor", "seg", "cnt", "kinds", "start", "n")).alias("want"))
    joined = left_lookup(texts, per_text, KEYS, "inner").select(*KEYS, "text", "want")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # rows that repeat come one after the other
        for b in batches:
            out, held = [], 0
            for i in range(b.num_rows):
                key = (b.column(0)[i].as_py(), b.column(1)[i].as_py())
                if key == last:
                    continue
                last = key
                u = units(b.column(2)[i].as_py())
                want = b.column(3)[i].values
                anchor, seg, cnt, kinds, start, n = (want.field(c).to_numpy(zero_copy_only=False)
                                                     for c in ("anchor", "seg", "cnt", "kinds", "start", "n"))
                size = n + length - 1
                step = np.cumsum(size) // BLOCK
                for some in np.split(np.arange(len(size)), np.flatnonzero(np.diff(step)) + 1):
                    parts = [u[start[j]:start[j] + size[j]] for j in some.tolist()]
                    at = anchor_places(anchor[some], parts, length, k)
                    for j, part, place in zip(some.tolist(), parts, at.tolist(), strict=True):
                        out.append((int(anchor[j]), int(seg[j]), int(cnt[j]), int(n[j]), place, part.tobytes(),
                                    int(kinds[j])))
                        held += part.nbytes
                    if held > 2 << 20:
                        yield _content_batch(out)
                        out, held = [], 0
            yield _content_batch(out)
            give_back()

    return joined.mapInArrow(run, CONTENT)


def _content_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 7
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                           names=["anchor", "seg", "cnt", "n", "at", "units", "kinds"])


Compare = Callable[[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]], list[np.ndarray]]


def compare_groups(content: DataFrame, unit: str, compare: Compare, batch_bytes: int) -> DataFrame:
    """Apply ``compare(anchor, cnt, anchor place, segments) -> marked starts of
    each`` to whole anchor groups, several per call; returns runs ``anchor, seg,
    lo, hi`` of starts."""
    dtype = np.uint8 if unit == "bytes" else np.uint64

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        marks = compare(*(np.array([r[i] for r in rows]) for i in (0, 2, 4)),
                        [np.frombuffer(r[5], dtype) for r in rows])
        out: list[tuple] = []
        for r, hit in zip(rows, marks, strict=True):
            edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
            out.extend((r[0], r[1], int(a), int(z)) for a, z in zip(edge[::2], edge[1::2], strict=True))
        cols = list(zip(*out, strict=True)) or [()] * 4
        return pa.record_batch([pa.array(c, t) for c, t in zip(
            cols, [pa.int64(), pa.int64(), pa.int32(), pa.int32()], strict=True)], names=["anchor", "seg", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[0] != last and size >= batch_bytes:
                    yield flush(held)
                    held, size = [], 0
                    give_back()
                held.append(row)
                size += len(row[5])
                last = row[0]
        if held:
            yield flush(held)

    ordered = content.repartition("anchor").sortWithinPartitions("anchor", "seg")
    return ordered.mapInArrow(run, "anchor long, seg long, lo int, hi int")


def slices(content: DataFrame, unit: str, length: int, width: int) -> DataFrame:
    """Every segment cut into slices of ``width`` starts by their distance to
    the anchor; a slice's new anchor is its core, which all its passages hold."""
    dtype = np.uint8 if unit == "bytes" else np.uint64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, held = [], 0
            for row in zip(*b.columns, strict=True):
                a, s, c, n, at, raw = (v.as_py() for v in row)
                u = np.frombuffer(raw, dtype)
                for q in range((at - n + 1) // width, at // width + 1):
                    low, high = at - q * width - width + 1, at - q * width  # starts of the whole slice
                    lo, hi = max(low, 0), min(high, n - 1)
                    core = xxhash.xxh64(u[high:low + length].tobytes())
                    core.update(b"%d:%d" % (a, q))
                    part = u[lo:hi + length].tobytes()
                    out.append((a, s, lo, core.intdigest(), xxhash.xxh64_intdigest(part), c, hi - lo + 1, at - lo, part))
                    held += len(part)
                if held > 2 << 20:
                    yield _slice_batch(out)
                    out, held = [], 0
            if out:
                yield _slice_batch(out)

    return content.mapInArrow(run, "of_anchor long, of_seg long, start int, anchor long, seg long, cnt long, n int, "
                                   "at int, units binary")


def _slice_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    signed = [np.array(cols[i], np.uint64).view(np.int64) for i in (3, 4)]
    return pa.record_batch(
        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
         pa.array(signed[0]), pa.array(signed[1]), pa.array(cols[5], pa.int64()), pa.array(cols[6], pa.int32()),
         pa.array(cols[7], pa.int32()), pa.array(cols[8], pa.binary())],
        names=["of_anchor", "of_seg", "start", "anchor", "seg", "cnt", "n", "at", "units"])


def repeated_runs(content: DataFrame, unit: str, length: int, compare: Compare, group_rows: int,
                  batch_bytes: int, width: int = 16) -> DataFrame:
    """Runs ``anchor, seg, lo, hi`` of repeated starts of ``CONTENT`` rows; anchors
    with more than ``group_rows`` segments by slices of ``width`` starts."""
    cols = ["anchor", "seg", "cnt", "n", "at", "units"]
    runs = compare_groups(content.filter(F.col("kinds") <= group_rows).select(*cols), unit, compare, batch_bytes)
    many = content.filter(F.col("kinds") > group_rows)
    if many.isEmpty():
        return runs
    cut = materialize(slices(many.select(*cols), unit, length, width), f"anchor-slices{width}")
    segs = materialize(cut.groupBy("anchor", "seg").agg(
        F.sum("cnt").alias("cnt"), F.first("n").alias("n"), F.first("at").alias("at"),
        F.first("units").alias("units")), f"anchor-cores{width}")
    kinds = materialize(segs.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"),
                        f"anchor-kinds{width}")
    # slices of one start are whole passages: equal ones are one segment by now
    inner = repeated_runs(segs.join(kinds, "anchor"), unit, length, compare, group_rows, batch_bytes,
                          max(width // 4, 1)) if width > 1 else None
    marks = segs.filter("cnt > 1").select("anchor", "seg", F.lit(0).alias("lo"), F.col("n").alias("hi"))
    if inner is not None:
        marks = marks.unionByName(inner.join(segs.filter("cnt = 1").select("anchor", "seg"), ["anchor", "seg"]))
    marks = materialize(marks, f"anchor-found{width}")
    back = cut.select("of_anchor", "of_seg", "start", "anchor", "seg").join(marks, ["anchor", "seg"]).select(
        F.col("of_anchor").alias("anchor"), F.col("of_seg").alias("seg"),
        (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"))
    return runs.unionByName(back)


def repeated_spans(texts: DataFrame, unit: str, length: int, k: int, compare: Compare,
                   group_rows: int = 1024, batch_bytes: int = 1 << 18) -> DataFrame:
    """``doc_id, th, spans``: of every text with repeats, the unit ranges
    (start, end) covered by a passage of ``length`` units that starts somewhere
    else too. Ranges may touch or overlap."""
    occ = materialize(occurrences(texts, unit, length, k), "anchor-occ")
    # a written right side lets adaptive execution split a hot anchor's rows
    often = materialize(occ.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("anchor"),
                        "anchor-twice")
    occ = materialize(occ.join(often, "anchor"), "anchor-often")
    segs = occ.groupBy("anchor", "seg").agg(
        F.count(F.lit(1)).alias("cnt"), F.min(F.struct("doc_id", "th", "start", "n")).alias("rep"))
    segs = materialize(segs, "anchor-segs")
    # written for the same reason: one exchange for the count and the join keeps a hot anchor in one task
    kinds = materialize(segs.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "anchor-kinds")
    wanted = segs.join(kinds, "anchor").select("anchor", "seg", "cnt", "kinds", "rep.*")
    content = materialize(contents(texts, wanted, unit, length, k), "anchor-content")
    runs = repeated_runs(content, unit, length, compare, group_rows, batch_bytes)
    part = runs.groupBy("anchor", "seg").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    whole = F.array(F.struct(F.lit(0).alias("lo"), F.col("rep.n").alias("hi")))
    full = segs.filter("cnt > 1").select("anchor", "seg", whole.alias("runs"))
    once = segs.filter("cnt = 1").select("anchor", "seg")
    marks = materialize(full.unionByName(once.join(part, ["anchor", "seg"])), "anchor-marks")
    # a row that is repeated has its segments several times: one of each is enough
    span = F.transform("runs", lambda r: F.struct((F.col("start") + r["lo"]).alias("start"),
                                                  (F.col("start") + r["hi"] + F.lit(length - 1)).alias("end")))
    return (occ.join(marks, ["anchor", "seg"]).select(*KEYS, span.alias("spans"))
            .groupBy(*KEYS).agg(F.flatten(F.collect_set("spans")).alias("spans")))


def merged(spans: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal ranges that spans (start, end) cover."""
    if not spans.is_valid or not len(spans.values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start, end = (spans.values.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "end"))
    by = np.argsort(start, kind="stable")
    start, reach = start[by], np.maximum.accumulate(end[by])
    new = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
    return start[new], np.r_[reach[new[1:] - 1], reach[-1]]


def span_lists(runs: list[tuple[np.ndarray, np.ndarray]]) -> pa.ListArray:
    """Merged runs of several texts as one Arrow column of (start, end) lists."""
    ends = np.cumsum([0, *(len(r[0]) for r in runs)])
    flat = [np.concatenate([r[i] for r in runs]) if runs else np.empty(0, np.int64) for i in (0, 1)]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                    pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in flat], ["start", "end"]))


def covered(spans: list[dict] | None, n: int) -> np.ndarray:
    """Boolean cover of ``n`` units by spans, for tests."""
    hit = np.zeros(n, bool)
    for s in spans or ():
        hit[s["start"]:s["end"]] = True
    return hit


def maximal_runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of a boolean cover, for tests."""
    edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))
