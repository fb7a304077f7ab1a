"""Conversation trie against a plain dictionary of all prefixes."""
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from enrichkit.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string, key string, n long, shard long, before boolean, depth long"


def plain(rows, rebuild=True):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, digest, (role, text)))
    convs = {c: [t[3] for t in sorted(ts)] for c, ts in convs.items()}
    if rebuild:
        def new(c):
            h = zlib.crc32(str(c).encode()) % 9
            return convs.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])[:h] + convs[c][h:]
        convs = {c: new(c) for c in convs}
    nodes = defaultdict(set)
    for c, s in convs.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].add(c)
    kids = defaultdict(set)
    for k in nodes:
        if k:
            kids[k[:-1]].add(k)
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    out = []
    for k, m in nodes.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(k))))
        out.append((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def talk(seed, convs=300, hot=True):
    rng = random.Random(seed)
    texts = ["", "hi", "Ünïcödé", "ok then", "a longer text " * 5]
    rows = []
    for c in range(convs):
        same = hot and c % 3 == 0                 # a third of all begin, and most of them go on, alike
        for t in range(rng.choice([1, 2, 4, 6, 9, 12])):
            pick = 0 if same and (t < 3 or rng.random() < .8) else rng.randrange(5)
            rows.append((c * rng.choice([1, 1, 1, 3]) - 20, t, ["user", "bot", None][t % 3 if pick else 0],
                         None if pick == 0 and t % 2 else texts[pick]))
    rows += [(5, None, "user", "first of all"), (5, None, "bot", "tie"), (7, 3, "user", "tie"), (7, 3, "bot", "tie"),
             (None, 0, "user", "nobody's"), (1000, 0, None, None), (1001, 0, "user", "y" * 200_000)]
    rows += [(2000, t, "user", f"{t}") for t in range(700)] + [(2005, t, "user", f"{t}") for t in range(650)]
    rng.shuffle(rows)
    return rows + rows[:5]


@pytest.mark.parametrize("shard_turns,rebuild", [(1 << 15, True), (200, False), (7, True), (1, False)])
def test_equals_plain_trie(spark, shard_turns, rebuild):
    rows = talk(1)
    df = spark.createDataFrame([(*r, "k", 1, 2, True, 3) for r in rows], SCHEMA).repartition(5)
    got = ct.conversation_trie(df, rebuild=rebuild, shard_turns=shard_turns).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, rebuild)


def test_empty_table_and_no_ids(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert ct.conversation_trie(df, rebuild=True).count() == 0
    df = spark.createDataFrame([(None, 1, "user", "x")], df.schema)
    assert ct.conversation_trie(df).count() == 0


def test_turnless_conversation_is_a_member_of_the_root(spark):
    c = next(c for c in range(1, 10**6, 5) if zlib.crc32(str(c).encode()) % 9 == 4)
    got = ct.conversation_trie(spark.createDataFrame([(c, 0, "user", "x")], "conv_id long, turn long, role string, text string"),
                               rebuild=True).collect()
    assert [tuple(r) for r in got] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_find_close():
    rng = random.Random(8)
    for _ in range(30):
        bits, depth = [], 0
        while len(bits) < 700 or depth:
            up = depth == 0 or (len(bits) < 700 and rng.random() < .55)
            bits.append(up)
            depth += 1 if up else -1
        bits = np.array(bits)
        stack, want = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                want[stack.pop()] = i
        excess = np.cumsum(np.where(bits, 1, -1)).astype(np.int32)
        at = np.flatnonzero(bits)
        assert ct.find_close(excess, at).tolist() == [want[i] for i in at.tolist()]


def test_ids_of_a_hot_sequence_come_in_pieces(spark):
    rows = [(c, 0, "user", "same") for c in range(400)] + [(c, 0, "user", str(c)) for c in range(400, 800)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    got = ct.conversation_trie(df, shard_turns=64, piece_ids=10).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, False)
