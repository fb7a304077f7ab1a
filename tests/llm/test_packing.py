import zlib

import numpy as np
import pytest
from enrichkit.llm.packing import cut_lengths, default_tokenizer_file, digest_payload, pack, word_ids
from pyspark.sql import functions as F


def encoded(text):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(default_tokenizer_file())
    return [*tok.encode(text or "", add_special_tokens=False).ids, 2]


def test_pieces_round_trip(hard):
    got = pack(hard, longest=64).collect()
    want = sorted(tuple(encoded(r.text)) for r in hard.select("text").collect())
    whole, part = [], {}
    by_doc = {}
    for r in got:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        assert len(r.ids) == 4 * r.length and r.length & (r.length - 1) == 0 and r.offset == 0
    flat = sorted(np.frombuffer(b"".join(bytes(r.ids) for r in got), "<u4").tolist())
    assert flat == sorted(i for w in want for i in w)
    singles = [k for k, v in by_doc.items() if len({r.start for r in v}) == len(v)]
    for k in singles:
        ids = b"".join(bytes(r.ids) for r in sorted(by_doc[k], key=lambda r: r.start))
        assert tuple(np.frombuffer(ids, "<u4").tolist()) in want
    seq = sorted(r.sequence_id for r in got)
    assert seq == list(range(len(got)))
    lengths = [r.length for r in sorted(got, key=lambda r: r.sequence_id)]
    assert lengths == sorted(lengths, reverse=True)
    del whole, part


def test_digest(hard):
    for r in pack(hard, payload={**digest_payload(), "ids": F.col("ids")}).collect():
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids))


@pytest.mark.parametrize("text", [
    "Hello, World!! it's 'tis don't we'll 3.14 a_b", "<|endoftext|>abc abc<|endoftext|>", "ΑΣ ΣΑΣ ﬁ Å é ẞß İ ſ",
    "a b c\u0085d\x1ce", "日本語 テキスト🙂🙂 x🙂y", "É'S L'ÉTÉ café -- ...", "x" * 300 + " " + "Ab1" * 80])
def test_words_encode_like_texts(text):
    ids = word_ids(default_tokenizer_file())
    got = b"".join(ids[w] for w in text.encode().split())
    assert np.frombuffer(got, "<u4").tolist() == encoded(text)[:-1]


def test_cut_lengths():
    for n in (0, 1, 5, 4095, 4096, 4097, 12345):
        parts = cut_lengths(n, 4096)
        assert sum(parts) == n and all(p & (p - 1) == 0 for p in parts)
        assert sorted(parts, reverse=True) == parts


def test_empty_table(nothing):
    assert pack(nothing).count() == 0


def test_ascii_words_skip_the_byte_level_step_and_keep_their_ids():
    from tokenizers import Tokenizer

    from enrichkit.llm.packing import WordIds, default_tokenizer_file
    tok = Tokenizer.from_file(default_tokenizer_file())
    ids, calls = WordIds(tok), []
    byte_level = ids.byte_level
    ids.byte_level = type("Counted", (), {"pre_tokenize_str": lambda _, w: calls.append(w) or byte_level.pre_tokenize_str(w)})()
    for word in ("plain", "Plain,", "SHOUT!", "été", "Größe.", "it's", "x1", "日本"):
        got = ids[word.encode()]
        assert [int.from_bytes(got[i:i + 4], "little") for i in range(0, len(got), 4)] == tok.encode(word, add_special_tokens=False).ids
    assert calls == ["été", "größe"]
