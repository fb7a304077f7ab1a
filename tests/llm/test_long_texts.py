"""Texts of tens of megabytes: memory of a worker and time of a scan stay in
proportion, and blocks change no result."""
import random
import re
import subprocess
import sys
import textwrap
import time
from pathlib import Path

import numpy as np
import pytest

from enrichkit.llm import anchors, secrets

REPO = Path(__file__).resolve().parents[2]


def test_blocks_change_nothing(monkeypatch):
    rng = random.Random(3)
    text = " ".join("w%d" % rng.randint(0, 300) for _ in range(4000)) + " " + "x" * 6000 + "\n\tend "
    units = [anchors.word_units(text.encode()), anchors.byte_units(text.encode())]
    whole = [anchors.segments(u, 40, 8) for u in units]
    for block in (1, 7, 1000):
        monkeypatch.setattr(anchors, "BLOCK", block)
        again = [anchors.word_units(text.encode()), anchors.byte_units(text.encode())]
        for u, v, w in zip(units, again, whole, strict=True):
            assert (u == v).all()
            for a, b in zip(w, anchors.segments(v, 40, 8), strict=True):
                assert (a == b).all()
        first, last = anchors.word_bounds(np.frombuffer(text.encode(), np.uint8))
        assert [(m.start(), m.end()) for m in re.finditer(r"\S+", text)] == list(zip(first, last, strict=True))


@pytest.mark.parametrize("unit", ["words", "bytes"])
def test_memory_of_one_long_text(unit):
    """A text of 50 MB adds at most 12 bytes a byte to a worker (bytes: its
    segments' keys and starts; words: also their hashes)."""
    code = textwrap.dedent(f"""
        import resource, numpy as np
        from enrichkit.llm import anchors
        rng = np.random.default_rng(1)
        text = rng.integers(97, 123, 50_000_000, dtype=np.uint8)
        text[rng.integers(0, len(text), 8_000_000)] = 32
        text = text.tobytes()
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        u = anchors.UNITS[{unit!r}](text)
        anchors.segments(u, *{(35, 8) if unit == "words" else (400, 32)})
        print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
    """)
    out = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, check=True)
    assert int(out.stdout) * 1024 < 12 * 50_000_000


def test_secrets_in_linear_time():
    rng = random.Random(5)
    allow = re.compile("|".join(f"(?:{p})" for p in secrets.ALLOW))
    run = "".join(rng.choice("0123456789abcdefABCDEF") for _ in range(1 << 20))
    lines = "\n".join("".join(rng.choice("0123456789abcdef") for _ in range(64)) for _ in range(20_000))
    words = "/".join(rng.choice(["example", "abc", "yourkey=1"]) for _ in range(100_000))
    for text in (run, lines, words):
        t0 = time.process_time()
        secrets.scan(text.encode(), allow)
        assert time.process_time() - t0 < 8       # about 1.5 s here; minutes when quadratic


def plain_entropy(text, allow):
    """The added spans spelled out: every window's entropy from its counts, every
    candidate against every span."""
    import math
    from collections import Counter
    out = []
    base = [s for s in secrets.base_spans(text)]
    for kind, (pattern, width, bits) in secrets.CLASSES.items():
        wide = [s for s in out if s[0] not in secrets.NARROW] if kind in secrets.NARROW else []
        for m in pattern.finditer(text):
            if allow.fullmatch(m[0]):
                continue
            keep = np.ones(len(m[0]), bool)
            for seg in re.finditer("[^/=]+", m[0]):
                if secrets.PLACEHOLDER.search(seg[0]) and allow.fullmatch(seg[0]):
                    keep[seg.start():seg.end()] = False
            cover = np.zeros(len(m[0]) + 1, bool)
            joined = []
            for i in range(len(m[0]) - width + 1):
                if not keep[i:i + width].all():
                    continue
                counts = Counter(m[0][i:i + width]).values()
                if -sum(c / width * math.log2(c / width) for c in counts) >= bits - 1e-9:
                    joined.append(i)
            for i in joined:
                cover[i:i + width] = True
            edge = np.flatnonzero(np.diff(np.r_[0, cover[:-1] * 1, 0]))
            # windows that only touch are one span, also across nothing
            for a, z in zip(edge[::2], edge[1::2], strict=True):
                a, z = m.start() + int(a), m.start() + int(z)
                if not allow.fullmatch(text, a, z) and not any(w[1] <= a and z <= w[2] for w in wide):
                    out.append((kind, a, z))
    spans = base + [s for s in out if not any(b[1] <= s[1] and s[2] <= b[2] for b in base)]
    return sorted(spans, key=lambda s: (s[1], secrets.KINDS.index(s[0]), s[2]))


def test_added_spans_equal_plain_windows():
    rng = random.Random(11)
    allow = re.compile("|".join(f"(?:{p})" for p in secrets.ALLOW))
    alphabets = ["abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789abcdef",
                 "0123456789ABCDEFabcdef", "abcXYZ019+/_=-ghijkLMNOP", "ab", "aeiourstln"]
    for _ in range(300):
        parts = []
        for _ in range(rng.randint(1, 8)):
            parts.append(rng.choice(["", "token=", "key: ", "AKIA", "example", "/", "=", "your_key/", " ", "\n", "é",
                                     "placeholderX"]))
            parts.append("".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 60)))
                         if rng.random() < .3 else
                         "".join(map(rng.choice, [rng.choice(alphabets)] * rng.randint(0, 60))))
        text = "".join(parts)
        want = plain_entropy(text, allow)
        assert secrets.scan(text.encode(), allow) == want, text
