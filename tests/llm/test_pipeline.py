"""Every stage of the pipeline on odd documents, against plain versions of its decision; the registered queries on sf0.001."""

from __future__ import annotations

import os

import duckdb
import pytest

import corpus_pipeline as cp
from strata.llm import registry

from .conftest import prose
from .test_jaccard_join import brute, edited

SMOKE = "/root/testdata/sf0.001"
ITEM = prose(900, 30)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory, make_docs, odd_docs):
    path = str(tmp_path_factory.mktemp("sf"))
    docs = list(odd_docs)
    docs += [(100 + i, edited(prose(60, 200), i, i)) for i in range(6)]
    docs += [(200, f"{prose(70, 50)} {ITEM} {prose(71, 50)}"), (201, f"{prose(72, 50)} {ITEM.replace('e', 'x', 3)}")]
    docs += [(300, "write to anna@example.org or +1 (988) 555-2485 " + prose(73, 40), None, None)]
    docs += [(400 + i, prose(400 + i, 60), ["en", "de"][i % 2], f"src{i % 3}") for i in range(12)]
    make_docs(docs).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """The documents, then what each stage returns for them, written and read again."""
    out = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for i, (_, stage) in enumerate(cp.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_columns_stay(stages):
    assert len(cp.STAGES) == 5
    for df in stages[1:5]:
        assert df.schema == stages[0].schema
    assert set(stages[0].columns) < set(stages[5].columns)


def test_language_drops_only_texts_without_letters(stages):
    before = [r for r in stages[0].collect() if r.text is not None and any(c.isalpha() for c in r.text)]
    after = stages[1].collect()
    assert sorted(map(str, (r.text for r in before))) == sorted(map(str, (r.text for r in after)))
    assert all(r.lang for r in after)


def test_one_of_each_group_stays(stages):
    before = [(r.doc_id, r.text) for r in stages[1].collect()]
    after = stages[2].collect()
    keys = [(i if d is None else d, t) for i, (d, t) in enumerate(before, start=10**6)]  # a null id comes last
    comp = brute([(j, t) for j, (_, t) in enumerate(sorted(keys, key=lambda x: x[0]))], 5, 80, 100)
    assert len(after) == len({c for *_, c in comp})
    assert {r.doc_id for r in after} >= {1, 7, 8, 9, 100, 200, 300}
    assert not {r.doc_id for r in after} & {101, 102, 103}


def test_leaks_go_and_the_rest_stays(stages):
    gone = {r.doc_id for r in stages[2].collect()} - {r.doc_id for r in stages[3].collect()}
    assert gone == {200, 201}


def test_personal_data_is_replaced(stages):
    before, after = stages[3].collect(), stages[4].collect()
    assert sorted(str(r) for r in before if r.doc_id != 300) == sorted(str(r) for r in after if r.doc_id != 300)
    (r,) = [r for r in after if r.doc_id == 300]
    assert r.text.startswith("write to [EMAIL] or [PHONE] ") and r.n_chars == len(r.text)


def test_mixture(stages):
    known = {str(r) for r in stages[4].collect()}
    rows = stages[5].collect()
    assert rows and all(r.mix_copies >= 1 and r.mix_tokens == len(r.text.split()) for r in rows)
    assert {str(r) for r in stages[5].select(stages[4].columns).collect()} <= known


def test_run_equals_its_stages(spark, sf_dir, stages):
    got = cp.run(spark, sf_dir)
    assert sorted(map(str, got.collect())) == sorted(map(str, stages[5].collect()))


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_registered_query(spark, name):
    """One query per operator, over whole tables; equal to its SQL where there is one."""
    df = registry.QUERIES[name](spark, SMOKE)
    rows = df.collect()
    assert rows
    if "doc_id" in df.columns and name not in ("op4_decontamination", "op7_source_mix"):
        ids = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id").collect()
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in ids)
    if name in registry.ORACLE_SQL:
        con = duckdb.connect()
        for table in ("documents", "conversations"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMOKE}/{table}.parquet'")
        want = con.sql(registry.ORACLE_SQL[name])
        assert sorted(want.columns) == sorted(df.columns)
        assert sorted(map(str, df.select(*want.columns).toPandas().itertuples(index=False))) == sorted(map(str, want.df().itertuples(index=False)))


def test_all_operators_are_registered():
    assert {int(n[2:].split("_")[0]) for n in registry.QUERIES} == set(range(1, 14)) and len(registry.QUERIES) == 13
    assert [n for n, _ in cp.STAGES] == ["language ID", "n-gram Jaccard join", "benchmark decontamination", "PII", "mixing sources"]


def test_language_is_predicted_once_a_row(spark, make_docs):
    docs = make_docs([(i, prose(i, 30)) for i in range(20)])
    plan = cp.language(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
