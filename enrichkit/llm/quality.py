"""Operator 9: document quality from a linear-chain conditional random field.

Every line is good or bad. A line's emission uses its own shape features and
those of the lines before and after it; transitions tie neighbouring labels.
The forward-backward marginals of a document's lines, weighted by line length,
give its raw quality, which a logistic curve fitted on training documents turns
into a probability.

Line labels are learnt from document labels: lines start with their document's
label, and lines of bad documents that the field is sure are good are relabelled
before it is fitted again. The fit uses a bounded sample (``sample`` documents a
class, the smallest id hashes), with both classes weighted by their true share;
scoring covers every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from enrichkit.llm.common import materialize, mix64

#: Line features in column order.
FEATURES = ("log_len", "upper", "digit", "symbol", "bar", "wide", "word_len", "same_as_last", "same_as_second",
            "ends_sentence", "words")
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"!\"#$%&()*+/:;<=>?@[\\]^_`{|}~")] = True


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features a line, line lengths, lines a text); an empty text has none."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    if not len(data):
        return np.zeros((0, len(FEATURES))), np.zeros(0), np.zeros(len(texts), np.int64)
    doc_start = np.r_[0, np.cumsum(sizes)[:-1]][sizes > 0]
    after = np.flatnonzero(data == 10) + 1
    starts = np.union1d(doc_start, after[after < len(data)])
    lines = np.searchsorted(starts, np.cumsum(sizes)) - np.searchsorted(starts, np.cumsum(sizes) - sizes)
    total = lambda mask: np.add.reduceat(mask.astype(np.int32), starts).astype(float)
    length = np.diff(np.r_[starts, len(data)]).astype(float)
    length -= total(data == 10)
    prev = np.r_[np.uint8(0), data[:-1]]
    accent = prev == 0xC3
    upper = total(_UPPER[data] | (accent & (data >= 0x80) & (data <= 0x9E)))
    lower = total(_LOWER[data] | (accent & (data >= 0x9F)))
    space = _SPACE[data]
    # words: a start follows white space, a line start or another text's end
    head = ~space & (np.r_[True, space[:-1]])
    head[starts] = ~space[starts]
    at = np.flatnonzero(head)
    n = 1.0
    same = [np.zeros(len(starts)), np.zeros(len(starts))]
    words = np.zeros(len(starts))
    letters = np.maximum(total(~space), n)
    if len(at):
        line_of = np.searchsorted(starts, at, "right") - 1
        place = np.arange(len(data)) - np.repeat(at, np.diff(np.r_[at, len(data)])) if at[0] == 0 else \
            np.arange(len(data)) - np.r_[np.zeros(at[0], np.int64), np.repeat(at, np.diff(np.r_[at, len(data)]))]
        unit = mix64((data.astype(np.uint64) + np.uint64(1)) | (place.astype(np.uint64) << np.uint64(8)))
        unit[space] = 0
        word = np.add.reduceat(unit, at)
        words = np.bincount(line_of, minlength=len(starts)).astype(float)
        for lag in (1, 2):
            eq = (word[lag:] == word[:-lag]) & (line_of[lag:] == line_of[:-lag])
            same[lag - 1] = np.bincount(line_of[lag:][eq], minlength=len(starts)) / np.maximum(words, n)
    cased = np.maximum(upper + lower, n)
    last = np.r_[starts[1:], len(data)] - 1
    last = np.where((data[last] == 10) & (last > starts), last - 1, last)
    full = np.maximum(length, n)
    x = np.column_stack([
        np.log1p(length) / 5, upper / cased, total(_DIGIT[data]) / letters, total(_SYMBOL[data]) / letters,
        total(data == 124) / full, total(data >= 0x80) / full, np.log1p(letters / np.maximum(words, n)),
        same[0], same[1], np.isin(data[last], np.frombuffer(b".!?", np.uint8)).astype(float), np.log1p(words) / 5])
    return x, length, lines


def with_neighbours(x: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Own, previous and next line's features, edge flags and a constant."""
    n = len(x)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    ends = np.cumsum(lines)[lines > 0]
    first[ends - lines[lines > 0]] = True
    last[ends - 1] = True
    before = np.vstack([x[:1], x[:-1]]) if n else x
    behind = np.vstack([x[1:], x[-1:]]) if n else x
    return np.hstack([x, np.where(first[:, None], 0, before), np.where(last[:, None], 0, behind),
                      first[:, None], last[:, None], np.ones((n, 1))])


def forward_backward(em: np.ndarray, lines: np.ndarray, trans: np.ndarray, weight: np.ndarray | None = None
                     ) -> tuple[np.ndarray, np.ndarray]:
    """(P(good) a line, expected transitions 2 x 2 summed over all texts, each
    line pair with its line's ``weight``).

    ``em`` is the score of good over bad. All texts advance together, so a step
    is one vector operation."""
    n = len(em)
    score = np.zeros((n, 2))
    score[:, 1] = em
    order = np.argsort(-lines, kind="stable")
    start = (np.cumsum(lines) - lines)[order]
    size = lines[order]
    longest = int(size[0]) if len(size) else 0
    act = [int(np.searchsorted(-size, -t, "left")) for t in range(longest + 1)]
    fwd, bwd = score.copy(), np.zeros((n, 2))
    for t in range(1, longest):
        i = start[:act[t]] + t
        fwd[i] += np.logaddexp(fwd[i - 1, 0, None] + trans[0], fwd[i - 1, 1, None] + trans[1])
    for t in range(longest - 2, -1, -1):
        i = start[:act[t + 1]] + t
        nxt = score[i + 1] + bwd[i + 1]
        bwd[i] = np.logaddexp(nxt[:, 0, None] + trans[:, 0], nxt[:, 1, None] + trans[:, 1])
    both = fwd + bwd
    z = np.logaddexp(both[:, 0], both[:, 1])
    inner = np.ones(n, bool)
    inner[(np.cumsum(lines) - lines)[lines > 0]] = False
    j = np.flatnonzero(inner)
    pair = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            each = np.exp(fwd[j - 1, a] + trans[a, b] + score[j, b] + bwd[j, b] - z[j])
            pair[a, b] = each.sum() if weight is None else (each * weight[j]).sum()
    return np.exp(both[:, 1] - z), pair


def _fit_field(x: np.ndarray, lines: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int
               ) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions by Adam on the penalised log-likelihood, in which
    each line has its text's ``weight``."""
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    inner = np.ones(len(y), bool)
    inner[(np.cumsum(lines) - lines)[lines > 0]] = False
    j = np.flatnonzero(inner)
    seen = np.array([[np.sum(weight[j] * ((y[j - 1] == a) & (y[j] == b))) for b in (0, 1)] for a in (0, 1)], float)
    for step in range(1, steps + 1):
        w, trans = theta[:-4], theta[-4:].reshape(2, 2)
        p, pair = forward_backward(x @ w, lines, trans, weight)
        grad = np.r_[x.T @ (weight * (y - p)), (seen - pair).ravel()] / weight.sum() - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def _raw_quality(p: np.ndarray, length: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Length-weighted mean marginal of every text; NaN without lines."""
    doc = np.repeat(np.arange(len(lines)), lines)
    weight = length + 1.0
    top = np.bincount(doc, p * weight, len(lines))
    with np.errstate(invalid="ignore"):
        return top / np.bincount(doc, weight, len(lines))


def _logit(q: np.ndarray) -> np.ndarray:
    q = np.clip(q, 1e-6, 1 - 1e-6)
    return np.log(q / (1 - q))


def fit(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = 150, rounds: int = 2,
        share: tuple[float, float] = (1.0, 1.0)) -> dict:
    """Model from per-text (line features, line lengths) and 0/1 labels; a text
    of class ``y`` stands for ``share[y]`` labelled texts."""
    keep = [i for i, (f, _) in enumerate(texts) if len(f)]
    if len({int(labels[i]) for i in keep}) < 2:
        return {}
    x = np.vstack([texts[i][0] for i in keep])
    length = np.concatenate([texts[i][1] for i in keep])
    lines = np.array([len(texts[i][1]) for i in keep])
    doc_y = labels[keep].astype(float)
    doc_w = np.asarray(share, float)[labels[keep].astype(int)]
    weight = np.repeat(doc_w, lines)
    mean = np.average(x, axis=0, weights=weight)
    scale = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=weight)) + 1e-3
    feats = with_neighbours((x - mean) / scale, lines)
    start = np.repeat(doc_y, lines)
    y = start.copy()
    for r in range(rounds):
        w, trans = _fit_field(feats, lines, y, weight, steps)
        p, _ = forward_backward(feats @ w, lines, trans)
        if r + 1 < rounds:
            y = np.where(start == 1, 1.0, (p > 0.9).astype(float))
            worst = np.minimum.reduceat(p, np.cumsum(lines) - lines)
            y[p == np.repeat(worst, lines)] = start[p == np.repeat(worst, lines)]  # a bad text has a bad line
    s = _logit(_raw_quality(p, length, lines))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of a lightly penalised logistic curve
        q = 1 / (1 + np.exp(-np.clip(a * s + b, -30, 30)))
        e = doc_w * (doc_y - q)
        g = np.array([(e * s).sum() - 0.1 * (a - 1), e.sum() - 0.1 * b])
        r = doc_w * q * (1 - q)
        h = np.array([[(r * s * s).sum() + 0.1, (r * s).sum()], [(r * s).sum(), r.sum() + 0.1]])
        move = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = max(a + move[0], 0.05), b + move[1]
    return {"mean": mean, "scale": scale, "w": w, "trans": trans, "a": a, "b": b}


def score_texts(texts: list[bytes], model: dict) -> np.ndarray:
    if not model:
        return np.where([len(t) > 0 for t in texts], 0.5, 0.0)
    x, length, lines = line_features(texts)
    feats = with_neighbours((x - model["mean"]) / model["scale"], lines)
    p, _ = forward_backward(feats @ model["w"], lines, model["trans"])
    q = _raw_quality(p, length, lines)
    out = 1 / (1 + np.exp(-np.clip(model["a"] * _logit(np.nan_to_num(q)) + model["b"], -30, 30)))
    return np.where(lines > 0, out, 0.0)


def _slices(column: pa.Array, limit: int = 2 << 20) -> Iterator[list[bytes]]:
    """Runs of texts of about ``limit`` bytes (a longer text is alone)."""
    held, size = [], 0
    for t in column:
        raw = t.as_py() or b""
        if held and size + len(raw) > limit:
            yield held
            held, size = [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield held


def held_out(id_col) -> "F.Column":
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = 3000, sample_lines: int = 500_000) -> dict:
    """Fit on at most ``sample`` labelled documents a class, none held out, that
    have at most ``sample_lines`` lines together (a document that would pass this
    is left out of the sample, never cut); each stands for the usable labels of
    its class per sampled one. Only their line features reach the driver, 48
    bytes a line. Rows with a null id or label, and ids with both labels, are not
    used."""
    ids = (labels.select(F.col(id_col).alias("k"), F.col(label_col).alias("y"))
           .filter(F.col("k").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("k")))
           .groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("y1")).filter("y = y1"))
    order = [F.xxhash64("k"), "k"]
    some = (ids.filter("y = 0").orderBy(*order).limit(sample)
            .unionByName(ids.filter("y = 1").orderBy(*order).limit(sample)))
    texts = (docs.select(F.col(id_col).alias("k"), F.col(text_col).cast("binary").alias("text"))
             .join(F.broadcast(some.select("k", "y")), "k").select("k", "y", "text"))  # at most 2 * sample ids
    lines = F.octet_length("text") - F.octet_length(F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))) + 1
    sized = materialize(texts.select("k", "y", F.xxhash64("text").alias("h"), F.coalesce(lines, F.lit(1)).cast("long").alias("lines")),
                        "quality-sample")
    so_far = F.sum("lines").over(Window.partitionBy("y").orderBy(F.xxhash64("k"), "k", "h")
                                 .rowsBetween(Window.unboundedPreceding, 0))     # at most 2 * sample documents
    fits = sized.withColumn("sum", so_far).filter(F.col("sum") <= sample_lines).select("k", F.col("h").alias("_h")).distinct()
    texts = texts.withColumn("_h", F.xxhash64("text")).join(F.broadcast(fits), ["k", "_h"], "left_semi").select("y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ys = b.column(0).to_pylist()
            rows = []
            for y, t in zip(ys, b.column(1), strict=True):
                x, length, _ = line_features([t.as_py() or b""])
                rows.append((int(y), x.astype(np.float32).tobytes(), length.astype(np.float32).tobytes()))
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()),
                                   pa.array([r[1] for r in rows], pa.binary()),
                                   pa.array([r[2] for r in rows], pa.binary())], names=["y", "x", "n"])

    got = sorted(texts.mapInArrow(run, "y int, x binary, n binary").collect(),
                 key=lambda r: (r["y"], bytes(r["n"]), bytes(r["x"])))
    pairs = [(np.frombuffer(r["x"], np.float32).reshape(-1, len(FEATURES)).astype(float),
              np.frombuffer(r["n"], np.float32).astype(float)) for r in got]
    if not got:
        return {}
    there = {r["y"]: r["count"] for r in ids.groupBy("y").count().collect()}
    used = {y: sum(r["y"] == y for r in got) for y in (0, 1)}
    share = tuple(max(there.get(y, 0) / max(used[y], 1), 1.0) for y in (0, 1))
    return fit(pairs, np.array([r["y"] for r in got]), share=share)


def score_quality(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    Defined cases: a null or empty text has score 0. Without usable labels of
    both classes (an empty model) every other text scores 0.5. Null ids are not
    held out. Repeated rows get a row each. An empty table gives no rows. Extra
    columns are ignored. Texts are read whole.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [score_texts(some, model) for some in _slices(b.column(1))]
            yield pa.record_batch([b.column(0), pa.array(np.concatenate([*parts, np.zeros(0)]))],
                                  names=["doc_id", "score"])

    scored = src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: dict, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least the threshold.
    An empty model rejects nothing: all rows stay."""
    if not model:
        return docs
    cols, at = docs.columns, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).cast(pa.binary())
            parts = [score_texts(some, model) for some in _slices(texts)]
            yield b.filter(pa.array(np.concatenate([*parts, np.zeros(0)]) >= threshold))

    return docs.select(*[F.col(f"`{c}`") for c in cols]).mapInArrow(run, docs.schema)
