"""Every pipeline stage against brute force on what the stage before it kept; odd inputs; registry."""

import re
from collections import Counter

import pytest
from llm_helpers import docs_df, near_dup_components, shard_statement, words

import corpus_pipeline as P
from mallsight.llm import quality, queries
from mallsight.llm.common import landed

SF = "/root/testdata/sf0.001"
STAGE = dict(P.STAGES)


@pytest.fixture(scope="module")
def chain(spark):
    """documents and the output of every stage, each written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in P.STAGES:
        docs = out[name] = landed(stage(spark, docs, SF), f"test-{name}")
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stage_order_and_columns(chain):
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "shard"]
    for name, _ in P.STAGES[:-1]:
        assert chain[name].columns == chain["documents"].columns
    assert chain["shard"].columns == [*chain["documents"].columns, "shard", "slot", "n_bytes"]


def test_quality_stage_keeps_the_predicted(spark, chain):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = {r.doc_id for r in quality.score_documents(chain["documents"], labels).filter("predicted = 1").collect()}
    assert Counter(chain["quality"].collect()) == Counter(r for r in chain["documents"].collect() if r.doc_id in want)
    known = {r.doc_id: r.quality for r in labels.collect()}
    clean = [i for i, _ in pairs(chain["documents"]) if known.get(i) == 1]
    assert sum(i in want for i in clean) >= 0.95 * len(clean)


def test_near_dedup_stage(chain):
    before = pairs(chain["quality"])
    comp = near_dup_components(before, 5, 80)
    assert sorted(i for i, _ in pairs(chain["near_dedup"])) == sorted({c for c in comp.values()})


def test_decontamination_stage(spark, chain):
    def grams(t):
        ws = re.findall(r"[^\W_]+", (t or "").lower())
        return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)}
    items = [grams(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert all(items)
    kept = {i for i, t in pairs(chain["near_dedup"]) if not any(100 * len(g & grams(t)) >= 80 * len(g) for g in items)}
    assert {i for i, _ in pairs(chain["decontaminate"])} == kept and len(kept) < chain["near_dedup"].count()


def test_mix_stage(chain):
    before, after = chain["decontaminate"].collect(), chain["mix"].collect()
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r.source] += len(words(r.text))
    for r in after:
        taken[r.source] += len(words(r.text))
    assert set(after) <= set(before) and max(Counter(after).values()) <= 2
    longest = max(len(words(r.text)) for r in before)
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= longest * len(sizes)
    assert all(taken[s] <= 2 * sizes[s] for s in sizes)


def test_shard_stage(chain):
    want = shard_statement(pairs(chain["mix"]), P.SHARDS, 16)
    assert sorted((r.doc_id, r.n_bytes, r.shard, r.slot) for r in chain["shard"].collect()) == sorted((i, n, s, k) for i, n, _, s, k in want)


def test_run_gives_the_chain(spark, chain):
    assert Counter(P.run(spark, SF).collect()) == Counter(chain["shard"].collect())


ODD = [(1, None, None), (2, "", "a"), (None, "some words with no id at all", "a"), (3, "x " * 3000, None),
       (4, "same text of six words here", "b"), (4, "same text of six words here", "b"), (5, "same text of six words here", "a")]


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stages_take_odd_and_empty_tables(spark, name):
    odd = docs_df(spark, ODD, extra=True)
    out = STAGE[name](spark, odd, SF)
    if name != "shard":
        assert out.columns == odd.columns
    rows = [(r.doc_id, r.text, r.source) for r in out.collect()]
    assert set(rows) <= set(ODD)
    if name == "near_dedup":
        assert Counter(rows) == Counter({k: 1 for k in ODD if k[0] != 5})
    if name in ("decontaminate", "shard"):
        assert Counter(rows) == Counter(ODD)
    assert STAGE[name](spark, odd.limit(0), SF).count() == 0


def test_registry():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    for n in range(1, 11):
        assert len([k for k in q if k.startswith(f"op{n}_")]) == 1
    assert "pipeline" in q and "pipeline" not in o and set(o) <= set(q)
    assert set(queries.QUERIES) - set(o) == {"op1_quality_classifier", "op11_secret_scan"}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracles(spark, name):
    import os
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(P.__file__)), "tools"))
    from oracle_check import duck, rows_of
    df = queries.QUERIES[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck(SF).execute(queries.ORACLE[name])
    names, want = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(names) and rows_of(cols, rows) == rows_of(names, want)


def test_quality_query_columns(spark):
    df = queries.QUERIES["op1_quality_classifier"](spark, SF)
    assert df.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    assert df.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
