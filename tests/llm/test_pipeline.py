"""The pipeline's stages on small tables, and that the registry follows the subpackage."""

import random

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from seawake.llm import queries
from tests.llm.brute import simhash


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(3)
    folder = str(tmp_path_factory.mktemp("tables"))
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(2000)]
    texts = {i: rng.choices(vocabulary, k=rng.randrange(80, 300)) for i in range(240)}
    toxic = {i for i in texts if i % 8 == 0}
    for i in toxic:
        for _ in range(6):
            texts[i].insert(rng.randrange(len(texts[i])), rng.choice(["vile", "nasty", "rotten"]))
    shared = rng.choices(vocabulary, k=60)
    for i in (41, 43, 45):
        texts[i][20:20] = shared
    rows = {i: " ".join(w) for i, w in texts.items()}
    rows[301] = rows[31].upper()
    long = rng.choices(vocabulary, k=3000)
    rows[303], rows[305] = " ".join(long), " ".join([*long[:1500], "odd", *long[1500:]])
    rows[307], rows[309] = None, ""
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    docs = [(i, t, "en", "s", len(t or "")) for i, t in rows.items()]
    spark.createDataFrame(docs, columns).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in texts]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, toxic, shared


def test_stages(spark, tables):
    folder, rows, toxic, shared = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
        kept.append({r["doc_id"]: r for r in docs.collect()})
    clean, exact, near, cut = kept
    assert set(clean) == set(rows) - toxic
    assert set(exact) == set(clean) - {31, 307}  # copies: the larger id stays
    assert bin(simhash(rows[303]) ^ simhash(rows[305])).count("1") <= 4
    assert set(near) == set(exact) - {305}
    assert set(cut) == set(near)
    for i in (41, 43, 45):
        words = rows[i].split()
        assert cut[i]["text"].split() == words[:20] + words[80:]
        assert cut[i]["n_chars"] == len(cut[i]["text"])
    unchanged = set(cut) - {41, 43, 45}
    assert all(cut[i]["text"] == rows[i] for i in unchanged)


def test_run_packs_all_that_is_left(spark, tables):
    folder, rows, toxic, _ = tables
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in out} == set(rows) - toxic - {31, 307, 305}
    assert all(r["offset"] + r["length"] <= 2048 for r in out)


def test_registry():
    names = set(entry.queries())
    assert set(queries.LLM_QUERIES) | {"pipeline"} <= names
    assert sorted(int(n.split("_")[0][2:]) for n in queries.LLM_QUERIES) == list(range(1, 11))
    assert set(queries.LLM_ORACLES) <= set(entry.oracle_sql())


def test_sql_of_exact_dedup(spark, tables):
    folder = tables[0]
    got = queries.op9_exact_dedup(spark, folder).toPandas()
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = database.execute(queries.LLM_ORACLES["op9_exact_dedup"]).df()
    columns = sorted(want.columns)
    assert sorted(map(str, got[columns].itertuples(index=False, name=None))) == sorted(map(str, want[columns].itertuples(index=False, name=None)))
