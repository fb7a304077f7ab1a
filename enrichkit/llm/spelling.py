"""Operator 11: spelling variants by blocked Gram matrices of letter counts.

Words are counted over all texts (a partial aggregate a word). Two words one edit
apart have letter counts that differ by one letter more, or by one letter for
another, so the squared distance of their count vectors is 1 or 2. Squared
distances come from matrix products of blocks of count vectors
(``|x|^2 + |y|^2 - 2 x.y``); pairs at most two apart are verified as edits.

A block holds the words of one length with equal counts over a few groups of
letters. One edit moves at most one count to another group, or adds one, so a
block only meets itself and blocks of its own and the adjacent length whose
group counts differ by just that: they are found by key, not by comparing all
blocks. A block with many words is dealt into parts, and what meets it meets every
part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrichkit.llm.common import give_back, materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
#: The letters of a run after lower-casing A-Z, by rule: a-z and U+00C0 to U+00FF.
ALPHABET = LOWER + "".join(map(chr, range(0xC0, 0x100)))
#: Guests compared at a time, and cells of a matrix.
STRIP = 1024


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 97) -> DataFrame:
    """``word``: every run of every text, lower-cased (A-Z) and, where ``modulus``
    divides the crc32 h of ``<id>:<run>``, without its code point h % length."""
    src = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                      F.explode(F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    without = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return src.withColumn("h", h).select(F.when(F.col("h") % modulus == 0, without).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, min_count: int = 3,
               modulus: int = 97) -> DataFrame:
    """``word, n`` of the words of at least ``min_length`` code points that occur
    at least ``min_count`` times in all texts together."""
    kept = words(docs, id_col, text_col, modulus).filter(F.length("word") >= min_length)
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def letter_groups(vocab: DataFrame, groups: int) -> list[str]:
    """The alphabet in groups of about equal use: letters by how many words
    count them, dealt there and back. One row a letter reaches the driver."""
    letter = F.explode(F.split("word", ""))
    used = dict(vocab.select(letter.alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("u")).collect())
    by_use = sorted(ALPHABET, key=lambda c: (-used.get(c, 0), c))
    out = [""] * groups
    for i, c in enumerate(by_use):
        turn, place = divmod(i, groups)
        out[place if turn % 2 == 0 else groups - 1 - place] += c
    return out


def group_counts(word: Column, groups: list[str]) -> list[Column]:
    """How many letters of each group a word has."""
    return [F.length(word) - F.length(F.translate(word, g, "")) for g in groups]


def _key(counts: list[Column]) -> Column:
    """A block's name."""
    return F.concat_ws(",", *counts)


def blocks(vocab: DataFrame, groups: list[str], block_letters: int) -> DataFrame:
    """``key, part, guest, word, n``: each word at home in one part of its block
    (``guest`` 0), a guest in all parts of its own block (1) and of the blocks an
    edit can lead to (2). Of two blocks of equally long words only the one with
    more letters of the earlier group visits, so two blocks meet once."""
    m = len(groups)
    counts = group_counts(F.col("word"), groups)
    named = vocab.select("word", "n", *[c.cast("int").alias(f"g{i}") for i, c in enumerate(counts)])
    g = [F.col(f"g{i}") for i in range(m)]
    own = named.select("word", "n", _key(g).alias("key"))
    parts = F.ceil(F.sum(F.length("word") + 64) / F.lit(float(block_letters))).cast("int")
    sizes = materialize(own.groupBy("key").agg(parts.alias("parts")), "spell-sizes")
    moved = [_key([g[k] + (1 if k == i else 0) for k in range(m)]) for i in range(m)]
    moved += [F.when(g[i] > 0, _key([g[k] - (1 if k == i else 0) + (1 if k == j else 0) for k in range(m)]))
              for i in range(m) for j in range(i + 1, m)]
    home = own.join(sizes, "key").select("key", F.pmod(F.xxhash64("word"), "parts").cast("int").alias("part"),
                                         F.lit(0).alias("guest"), "word", "n")
    visits = F.array_compact(F.array(F.struct(_key(g).alias("key"), F.lit(1).alias("guest")),
                                     *[F.when(k.isNotNull(), F.struct(k.alias("key"), F.lit(2).alias("guest"))) for k in moved]))
    guest = named.select("word", "n", F.inline(visits)).join(sizes, "key")
    guest = guest.select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "guest", "word", "n")
    return home.unionByName(guest)


def _codes(some: list[str], width: int) -> np.ndarray:
    """Row per word of its letters' numbers (1 up), 0 behind its end."""
    flat = np.frombuffer("".join(w.ljust(width, "\0") for w in some).encode("utf-32-le"), np.uint32)
    flat = np.where(flat == 0, 0, np.where(flat < 0xC0, flat - 96, flat - 0xC0 + 27)).astype(np.uint8)
    return flat.reshape(len(some), width)


def _counts(codes: np.ndarray) -> np.ndarray:
    rows, width = codes.shape
    # sums of products stay exact: below 2**24 in single, 2**53 in double precision
    kind = np.float32 if width < 4000 else np.float64
    at = (np.arange(rows)[:, None] * (len(ALPHABET) + 1) + codes).ravel()
    table = np.bincount(at, minlength=rows * (len(ALPHABET) + 1)).reshape(rows, -1)
    return table[:, 1:].astype(kind)


def close_pairs(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of two count blocks with a squared distance of at most two."""
    sx, sy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    gram = x @ y.T
    gram *= 2
    gram -= sy[None, :]
    return np.nonzero(gram >= sx[:, None] - 2)


def one_edit(a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Which rows of two code blocks (``la`` letters, and ``lb`` or one more) are
    apart by exactly one replaced or one inserted letter."""
    same = a == b
    replaced = (la == lb) & ((~same).sum(axis=1) == 1)
    # the first difference is left out of the longer word, what follows must agree
    first = np.where(same.all(axis=1), a.shape[1], same.argmin(axis=1))
    after = np.arange(a.shape[1] - 1)[None, :] >= first[:, None]
    inserted = (lb == la + 1) & (~after | (a[:, :-1] == b[:, 1:])).all(axis=1)
    return replaced | inserted


def _best(word: np.ndarray, n: np.ndarray, near: np.ndarray, near_n: np.ndarray) -> tuple[np.ndarray, ...]:
    """A row a word: its count, how many near words, the one of largest count
    (of equal ones the first in code-point order) and that count."""
    by = np.lexsort((near, -near_n, word))
    word = word[by]
    lead = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    return word[lead], n[by][lead], np.diff(np.r_[lead, len(word)]), near[by][lead], near_n[by][lead]


def _strips(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Column arrays of a bounded number of rows, and letters, of one (key,
    part, guest). Words of one block differ in length by one at most."""
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        new = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols[:3]])) + 1
        for lo, hi in zip(np.r_[0, new].tolist(), np.r_[new, b.num_rows].tolist(), strict=True):
            step = max(1, min(STRIP, (STRIP << 6) // len(cols[3][lo])))
            for at in range(lo, hi, step):
                yield [c[at:min(at + step, hi)] for c in cols]


def near_words(placed: DataFrame) -> DataFrame:
    """``word, n, n_near, near, near_n``: partial results, a row for a word and
    two strips that meet with near words in them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, home = None, []
        for keys, parts, guest, w, n in _strips(batches):
            if (keys[0], parts[0]) != key:
                key, home = (keys[0], parts[0]), []
            size = np.array([len(x) for x in w])
            codes = _codes(w.tolist(), int(size.max()) + 1)
            strip = (w, n, size, codes, _counts(codes))
            if guest[0] == 0:
                home.append(strip)
                continue
            rows = [r for h in home for r in _meet(strip, h, own=guest[0] == 1)]
            if rows:
                cols = [np.concatenate(c) for c in zip(*rows, strict=True)]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)
        give_back()

    names = ["word", "n", "n_near", "near", "near_n"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    ordered = placed.repartition("key", "part").sortWithinPartitions("key", "part", "guest", "word")
    return ordered.mapInArrow(run, "word string, n long, n_near long, near string, near_n long")


def _meet(strip: tuple, home: tuple, own: bool) -> list[tuple[np.ndarray, ...]]:
    """A strip of guests against one of the block they visit. Words of one block
    visit each other, so there each side is told by its own visit."""
    w, n, size, codes, counts = strip
    hw, hn, hsize, hcodes, hcounts = home
    kind = np.result_type(counts, hcounts)
    i, j = close_pairs(counts.astype(kind, copy=False), hcounts.astype(kind, copy=False))
    width = max(codes.shape[1], hcodes.shape[1])
    a, b = (np.pad(c, ((0, 0), (0, width - c.shape[1]))) for c in (codes, hcodes))
    step = max(1, (STRIP << 8) // width)
    ok = [one_edit(a[i[at:at + step]], b[j[at:at + step]], size[i[at:at + step]], hsize[j[at:at + step]])
          for at in range(0, len(i), step)]
    hit = np.flatnonzero(np.concatenate(ok)) if ok else []
    if not len(hit):
        return []
    i, j = i[hit], j[hit]
    out = [_best(w[i], n[i], hw[j], hn[j])]
    if not own:
        out.append(_best(hw[j], hn[j], w[i], n[i]))
    return out


def roots(forms: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``word, root`` of ``word, form`` (never null): forms followed to the last.
    A form's count is twice its word's at least, so there are no circles and
    chains are short; pointers are doubled each round."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "spell-roots")
    for _ in range(max_rounds):
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = materialize(at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                              F.col("further").isNotNull().alias("moved")), "spell-roots")
        if not step.agg(F.max("moved")).first()[0]:
            return at
        at = step.select("word", "root")
    raise RuntimeError(f"roots not reached in {max_rounds} rounds")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5,
                      min_count: int = 3, ratio: int = 2, modulus: int = 97, groups: int = 5,
                      block_letters: int = 1 << 18) -> DataFrame:
    """Words and the more frequent spelling each belongs to.

    Returns one row per word: ``word, form, root, n, n_near, form_n``. ``n_near``
    counts the words one inserted, deleted or replaced code point away; ``form`` is
    the one of largest n (ties: smallest in code-point order) where that is
    ``ratio`` times the word's at least, ``root`` the last form reached.

    Defined cases: a null or empty text has no words; a null id counts as an empty
    one. Repeated rows are counted as often as they occur. An empty table gives no
    rows. Extra columns are ignored. Texts and words of any length are whole.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    vocab = materialize(vocabulary(docs, id_col, text_col, min_length, min_count, modulus), "spell-words")
    placed = blocks(vocab, letter_groups(vocab, groups), block_letters)
    near = near_words(placed).groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    found = vocab.join(near, "word", "left")
    is_form = -F.col("top.less") >= ratio * F.col("n")
    found = materialize(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                     F.when(is_form, F.col("top.near")).alias("form"),
                                     F.when(is_form, -F.col("top.less")).alias("form_n")), "spell-near")
    last = roots(found.filter("form is not null"))
    return found.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: crc32 in DuckDB SQL: the table of the reflected polynomial by its rule, and a
#: reduction over the bytes of a text (code points below U+0800).
CRC_TABLE_SQL = """crc AS (SELECT list_transform(range(256), lambda v: list_reduce([v, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(3988292384, x >> 1) ELSE x >> 1 END)) AS tab)"""


def crc_sql(text: str) -> str:
    """SQL for the unsigned crc32 of a text expression, next to a row of ``crc``."""
    data = (f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] "
            "ELSE [192 | (ord(c)::BIGINT >> 6), 128 | (ord(c)::BIGINT & 63)] END))")
    return (f"xor(list_reduce(list_prepend(4294967295, {data}), "
            "lambda a, b: xor(a >> 8, tab[1 + (xor(a, b) & 255)])), 4294967295)")


#: The same rows in DuckDB: near words by shared patterns (a word with one code
#: point left out, or masked), forms followed by a recursive query.
ORACLE_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
per AS (SELECT doc_id, run, count(*) AS c FROM runs GROUP BY ALL),
hashed AS (SELECT run, c, {crc_sql("concat(doc_id, ':', run)")} AS h FROM per, crc),
cut AS (SELECT CASE WHEN h % 97 = 0 THEN concat(run[:(h % length(run))], run[(h % length(run)) + 2:]) ELSE run END AS word, c
        FROM hashed),
vocab AS (SELECT word, sum(c)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
places AS (SELECT word, n, unnest(range(length(word))) AS p FROM vocab),
less AS (SELECT DISTINCT word, n, concat(word[:p], word[p + 2:]) AS w FROM places),
mask AS (SELECT word, n, p, concat(word[:p], '*', word[p + 2:]) AS w FROM places),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM mask a JOIN mask b ON a.w = b.w AND a.p = b.p AND a.word <> b.word
         UNION ALL SELECT l.word, l.n, v.word, v.n FROM less l JOIN vocab v ON l.w = v.word
         UNION ALL SELECT v.word, v.n, l.word, l.n FROM less l JOIN vocab v ON l.w = v.word),
top AS (SELECT word, any_value(n) AS n, count(*) AS n_near, arg_min(other, (-other_n, encode(other))) AS near_word,
               max(other_n) AS near_n FROM near GROUP BY word),
formed AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 2 * v.n THEN near_word END AS form,
                  CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n FROM vocab v LEFT JOIN top USING (word)),
follow(word, last) AS (SELECT word, word FROM formed
                     UNION ALL SELECT f.word, g.form FROM follow f JOIN formed g ON f.last = g.word WHERE g.form IS NOT NULL),
ended AS (SELECT f.word, f.last AS root FROM follow f JOIN formed g ON f.last = g.word WHERE g.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ended USING (word)"""
