"""Operator 2: packing by power-of-two decomposition.

A document of n tokens is cut into full pieces of the longest length and then
into the powers of two of what remains (the binary digits of n, high to low).
Every piece is a sequence of its own and equal lengths form a bucket, so no
sequence holds tokens of two documents and none needs padding: a trainer draws
whole batches from one bucket.
"""

from __future__ import annotations

import os
import re
import struct
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from enrichkit.llm.common import materialize

#: Words whose ids do not depend on anything but their letters: basic and
#: accented Latin letters, then ASCII punctuation without the apostrophe.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")


class WordIds(dict):
    """Token ids (little-endian uint32 bytes) of each white-space separated
    word, looked up once and kept. The tokenizer drops white space and never
    joins characters across it, so a text's ids are its words' ids in order.
    The map is emptied when full: it bounds memory and never changes a result."""

    def __init__(self, tokenizer, limit: int = 600_000):
        super().__init__()
        from tokenizers import pre_tokenizers
        self.tok, self.limit = tokenizer, limit
        self.model = tokenizer.model
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, word: bytes) -> bytes:
        ids = self._encode(word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = ids
        return ids

    def _encode(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        plain = _PLAIN.fullmatch(text)
        if plain:
            core, tail = plain.groups()
            if tail:
                return self[core.lower().encode()] + self[tail.encode()]
            if core.islower():
                # the byte-level alphabet writes ASCII letters as they are
                mapped = core if core.isascii() else self.byte_level.pre_tokenize_str(core)[0][0]
                return _pack([t.id for t in self.model.tokenize(mapped)])
            return self[core.lower().encode()]
        return _pack(self.tok.encode(text, add_special_tokens=False).ids)


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_CACHE: dict[str, WordIds] = {}


def word_ids(tokenizer_file: str) -> WordIds:
    """One word map per Python worker and file, reused by its tasks."""
    if tokenizer_file not in _CACHE:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        _CACHE[tokenizer_file] = WordIds(Tokenizer.from_file(tokenizer_file))
    return _CACHE[tokenizer_file]


def cut_lengths(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: full ones, then binary digits."""
    out = [longest] * (n // longest)
    rest, bit = n % longest, longest >> 1
    while bit:
        if rest & bit:
            out.append(bit)
        bit >>= 1
    return out


def default_tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def cut_documents(docs: DataFrame, id_col: str, text_col: str, longest: int, end_id: int,
                  tokenizer_file: str | None) -> DataFrame:
    """Pieces of every document: ``doc_id, doc_tokens, start, length, nth, ids``
    (binary, little-endian unsigned 32-bit token ids); ``nth`` counts the
    pieces of one length within a task."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    file = tokenizer_file or default_tokenizer_file()
    end = end_id.to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, seen = word_ids(file).__getitem__, Counter()
        for batch in batches:
            rows, held = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = b"".join(map(ids_of, (text.as_py() or b"").split())) + end
                n, at = len(ids) // 4, 0
                for length in cut_lengths(n, longest):
                    rows.append((doc, n, at, length, seen[length], ids[4 * at:4 * (at + length)]))
                    seen[length] += 1
                    at += length
                held += len(ids)
                if held > 8 << 20:
                    yield _batch(rows, batch.schema.field(0).type)
                    rows, held = [], 0
            yield _batch(rows, batch.schema.field(0).type)

    return src.mapInArrow(
        pieces, f"doc_id {id_type}, doc_tokens long, start long, length long, nth long, ids binary")


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 6
    types = [id_type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                           names=["doc_id", "doc_tokens", "start", "length", "nth", "ids"])


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = 4096,
         end_id: int = 2, tokenizer_file: str | None = None,
         payload: dict[str, Column] | None = None) -> DataFrame:
    """Pack documents into sequences, one power-of-two piece each.

    Returns one row per piece: ``doc_id, start, length, doc_tokens,
    sequence_id, offset`` and the ``payload`` columns, expressions over a piece
    with its ``ids`` (default: the ids themselves, little-endian uint32).
    ``sequence_id`` counts from 0 by length, longest first: each length's bucket
    is one gapless range of ids. ``offset`` is 0, as a sequence holds exactly one
    piece. The pieces are written once with their place in their task, and a
    bucket's ids start where the tasks before end, so token ids never shuffle.

    Defined cases: a null or empty text is the end token alone (one piece of
    length 1). A null id is an id like any other. Repeated rows each give their
    own pieces with their own sequences. An empty table gives no rows. Extra
    columns are ignored. Texts of any length are cut whole.
    """
    payload = {"ids": F.col("ids")} if payload is None else payload
    cut = materialize(cut_documents(docs, id_col, text_col, longest, end_id, tokenizer_file).select(
        "doc_id", "start", "length", "doc_tokens", "nth", F.spark_partition_id().alias("task"),
        *[c.alias(k) for k, c in payload.items()]), "pack-pieces")
    per = materialize(cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    longer = Window.orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    bucket = per.groupBy("length").agg(F.sum("n").alias("n")).select(  # one row per piece length
        "length", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("base"))
    first = per.join(bucket, "length").select(
        "length", "task", (F.col("base") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("first"))
    return (cut.join(materialize(first, "pack-first"), ["length", "task"])
            .withColumn("sequence_id", F.col("first") + F.col("nth"))
            .withColumn("offset", F.lit(0).cast("long")).drop("first", "nth", "task"))


def digest_payload() -> dict[str, Column]:
    return {"ids_crc32": F.crc32("ids")}
