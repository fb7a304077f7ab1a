"""Operator 7: secret scan with sliding-window entropy.

Three base patterns find assignments, access keys and long hex runs. On top of
them, candidate strings (long runs of one character class) are scanned with a
window of fixed width; the window's Shannon entropy is kept up to date from
character counts as it slides, and windows above the class's threshold merge
into spans. Strings on the allow-list are suppressed.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = re.compile(
    "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII | re.IGNORECASE)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
LONG_HEX = re.compile("[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "entropy_base64", "entropy_hex", "entropy_lower", "entropy_upper")

#: Character classes of candidate strings: pattern, window width, bits a character.
CLASSES = {
    "entropy_base64": (re.compile("[A-Za-z0-9+/_=-]{24,}"), 24, 4.0),
    "entropy_hex": (re.compile("[0-9A-Fa-f]{24,}"), 24, 3.0),
    "entropy_lower": (re.compile("(?<![A-Za-z0-9])[a-z0-9]{16,}(?![A-Za-z0-9])"), 16, 3.5),
    "entropy_upper": (re.compile("(?<![A-Za-z0-9])[A-Z0-9]{16,}(?![A-Za-z0-9])"), 16, 3.5),
}
#: Classes whose spans are added only where no other entropy span covers them.
NARROW = ("entropy_lower", "entropy_upper")
#: Words of path segments that say they are no secrets; only the segments between
#: ``/`` and ``=`` that hold one are left out of a run.
PLACEHOLDER = re.compile("(?i:example|placeholder|changeme|your[_-]?key)")
SEPARATOR = re.compile("[/=]")

#: Strings that look random to a window but are no secrets (whole matches).
ALLOW = (
    "[A-Z]?[a-z]+", "[A-Z]+", "[0-9]+",                       # one word, one number
    "(?:[A-Z]?[a-z]{2,}|[A-Z]+)(?:[-_/=+](?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*[-_/=+]*",  # joined words
    "[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}",   # UUID
    "(?i:[^/=]*(?:example|placeholder|changeme|your[_-]?key)[^/=]*)",
    "(?:0123456789|abcdefghijklmnopqrstuvwxyz|ABCDEFGHIJKLMNOPQRSTUVWXYZ|[+/_=-])+",
)

_WORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")


def _mask(chars: bytes) -> bytes:
    return bytes(0x63 if b in chars else 0x20 for b in range(256))


_HEX_MASK = _mask(b"0123456789abcdef")
_RUN_MASK = _mask(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-")


def entropy_windows(s: str, width: int, bits: float) -> list[tuple[int, int]]:
    """Merged spans of the windows of ``s`` whose entropy is at least ``bits``.

    H = log2(w) - sum(c * log2 c) / w; a slide changes two counts."""
    if len(s) < width:
        return []
    term = [0.0, 0.0] + [c * math.log2(c) for c in range(2, width + 1)]
    most = width * (math.log2(width) - bits) + 1e-9
    count: dict[str, int] = {}
    total, out = 0.0, []
    for i, ch in enumerate(s):
        if i >= width:
            old = s[i - width]
            c = count[old]
            count[old] = c - 1
            total += term[c - 1] - term[c]
        c = count.get(ch, 0)
        count[ch] = c + 1
        total += term[c + 1] - term[c]
        if i >= width - 1 and total <= most:
            start = i - width + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds, leftmost non-overlapping within a kind."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    # a maximal run of 16 or more is what filtering all maximal runs leaves
    out += [("hex", m.start(), m.end()) for m in LONG_HEX.finditer(text)]
    return out


def _pieces(run: str, allow: re.Pattern) -> Iterator[tuple[int, str]]:
    """What a run holds between its allowed placeholder segments; every
    character is looked at a fixed number of times."""
    at = seen = 0
    for m in PLACEHOLDER.finditer(run):
        if m.start() < seen:
            continue
        first = max(run.rfind("/", seen, m.start()), run.rfind("=", seen, m.start())) + 1 or seen
        stop = SEPARATOR.search(run, m.end())
        seen = stop.start() if stop else len(run)
        if allow.fullmatch(run, first, seen):
            yield at, run[at:first]
            at = seen
    yield at, run[at:]


class Cover:
    """Spans of each kind are sorted and apart: one look a kind tells whether a
    range lies within one of them."""

    def __init__(self, spans: Sequence[tuple[str, int, int]]):
        self.kinds: dict[str, tuple[list[int], list[int]]] = {}
        for kind, start, end in spans:
            starts, ends = self.kinds.setdefault(kind, ([], []))
            starts.append(start)
            ends.append(end)

    def holds(self, start: int, end: int) -> bool:
        for starts, ends in self.kinds.values():
            i = bisect.bisect_right(starts, start) - 1
            if i >= 0 and end <= ends[i]:
                return True
        return False


def entropy_spans(text: str, allow: re.Pattern) -> list[tuple[str, int, int]]:
    out = []
    wide = None
    for kind, (pattern, width, bits) in CLASSES.items():
        if kind in NARROW and wide is None:
            wide = Cover(out)
        for m in pattern.finditer(text):
            if allow.fullmatch(m[0]):
                continue
            for skip, piece in _pieces(m[0], allow):
                at = m.start() + skip
                out.extend((kind, at + a, at + b) for a, b in entropy_windows(piece, width, bits)
                           if not allow.fullmatch(text, at + a, at + b)
                           and not (wide is not None and wide.holds(at + a, at + b)))
    return out


def scan(raw: bytes, allow: re.Pattern) -> list[tuple[str, int, int]]:
    """All spans of a text, by start and then kind. Byte tests that every match
    needs come first; most texts are never decoded."""
    assign = any(w in low for low in (raw.lower(),) for w in _WORDS)
    runs = b"c" * 16 in raw.translate(_RUN_MASK)
    if not (assign or runs or b"AKIA" in raw or b"c" * 16 in raw.translate(_HEX_MASK)):
        return []
    text = raw.decode("utf-8", "replace")
    spans = base_spans(text)
    if runs:
        base = Cover(spans)
        spans += [s for s in entropy_spans(text, allow) if not base.holds(s[1], s[2])]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 allow: Sequence[str] = ALLOW) -> DataFrame:
    """Secrets in every whole text: ``doc_id, spans`` with spans an array of
    ``kind, start, end`` (code points, end exclusive), by start, then kind.

    Base kinds ``assign, access, hex`` always stay; entropy spans are added
    where no base span covers them and the allow-list does not match the
    candidate or the span.

    Defined cases: a null or empty text has no spans. Null ids and repeated
    rows give a row each. An empty table gives no rows. Extra columns are
    ignored. Texts of any length are scanned whole.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    allow_text = "|".join(f"(?:{p})" for p in allow) or "(?!)"
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = re.compile(allow_text)
        for b in batches:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in scan(t.as_py() or b"", allowed)]
                     for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(found, pa.list_(span))], names=["doc_id", "spans"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, "
                               "spans array<struct<kind:string,start:long,end:long>>")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``scan_secrets`` rows."""
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"),
                        n("hex").alias("n_hex"), F.sha2(text(base), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"))


def plain_spans(text: str) -> str:
    """The base contract spelled out, for tests: all matches, failing ones dropped."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text) if len(m[0]) >= 16]
    out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in out)


def plain_digest(text: str) -> str:
    return hashlib.sha256(plain_spans(text).encode()).hexdigest()
