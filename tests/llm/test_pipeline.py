"""The corpus pipeline against brute force, stage by stage."""
import sys
import tempfile
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from test_mixing import plain_targets
from test_packing import encoded
from test_quality import make
from test_simhash import plain_components, plain_fingerprint

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline as cp  # noqa: E402


@pytest.fixture(scope="module")
def docs(spark, hard):
    """Hard rows between plain prose and junk with labels."""
    more, labels = make(spark, 150)
    more = more.selectExpr("doc_id + 1000 AS doc_id", "text", "'en' AS lang",
                           "concat('s', doc_id % 4) AS source", "length(text) AS n_chars")
    root = tempfile.mkdtemp()
    labels.selectExpr("doc_id + 1000 AS doc_id", "quality").write.parquet(f"{root}/labels.parquet")
    both = hard.select(*cp.COLUMNS).unionByName(more.selectExpr(
        "doc_id", "text", "lang", "source", "CAST(n_chars AS long) AS n_chars"))
    both.write.parquet(f"{root}/documents.parquet")
    return root, spark.read.parquet(f"{root}/documents.parquet")


def rows(df):
    return [tuple(r) for r in df.select(*cp.COLUMNS).collect()]


def size(r):
    return len((r[1] or "").encode().split())


def test_stages_against_brute_force(spark, docs):
    """The stages in order, each written and read again, each judged on its
    own input."""
    from enrichkit.llm import quality
    from enrichkit.llm.common import materialize
    root, df = docs
    stage = dict(cp.STAGES)
    assert list(stage) == ["quality", "exact_dedup", "simhash", "mixing", "packing"]

    # quality: exactly the rows whose text the model accepts
    kept = materialize(stage["quality"](spark, df, root), "t-quality")
    model = quality.train(df, spark.read.parquet(f"{root}/labels.parquet"))
    want = Counter(r for r in rows(df) if quality.score_texts([(r[1] or "").encode()], model)[0] >= 0.7)
    assert kept.columns == cp.COLUMNS and Counter(rows(kept)) == want and want

    # exact dedup, on all rows: one row a text, the one with the largest id
    before = rows(df)
    unique = materialize(stage["exact_dedup"](spark, df, root), "t-exact")
    texts = defaultdict(list)
    for r in before:
        texts[r[1] or ""].append(r[0])
    out = rows(unique)
    assert unique.columns == cp.COLUMNS and len(out) == len(texts) == len({r[1] or "" for r in out})
    for r in out:
        assert r[0] == max((i for i in texts[r[1] or ""] if i is not None), default=None)

    # SimHash, on all rows again: one row a component, the one with the smallest id
    near = materialize(stage["simhash"](spark, df, root), "t-near")
    comp = plain_components([plain_fingerprint(r[1]) for r in before], list(range(len(before))), 3)
    groups = defaultdict(list)
    for c, r in zip(comp, before, strict=True):
        groups[c].append(r[0])
    out = rows(near)
    assert near.columns == cp.COLUMNS and len(out) == len(groups) and not Counter(out) - Counter(before)
    assert Counter(r[0] for r in out) == Counter(
        min((i for i in v if i is not None), default=None) for v in groups.values())

    # mixing: rows as often as taken, near each source's target
    mixed = materialize(stage["mixing"](spark, unique, root), "t-mix")
    out, total, taken = rows(mixed), defaultdict(int), defaultdict(int)
    for r in rows(unique):
        total[r[3]] += size(r)
    for r in out:
        taken[r[3]] += size(r)
    assert mixed.columns == cp.COLUMNS and set(out) <= set(rows(unique)) and max(Counter(out).values()) <= 3
    for s, target in plain_targets(dict(total), (1, 2, 3), 3.0).items():
        assert abs(taken[s] - target) <= max(5, 0.05 * target)

    # packing: every copy whole, one sequence a piece
    packed = stage["packing"](spark, mixed, root).collect()
    assert sorted(r.sequence_id for r in packed) == list(range(len(packed)))
    assert sum(r.length for r in packed) == sum(len(encoded(r[1])) for r in out)


@pytest.mark.parametrize("name", [name for name, _ in cp.STAGES])
def test_empty_documents(spark, docs, name):
    root, df = docs
    assert dict(cp.STAGES)[name](spark, df.limit(0), root).count() == 0
