"""Registered queries of the corpus operators over the given tables."""

import os

import duckdb
import pytest

import corpus_pipeline
from voxtally.llm import bpe, secrets
from voxtally.llm.queries import ORACLE_SQL, QUERIES, TOKENIZERS, jaccard_sql, vocabulary

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, documents, sql, name):
    found = QUERIES[name](spark, SF_DIR)
    result = sql.execute(ORACLE_SQL[name])
    names = sorted(c[0] for c in result.description)
    at = [[c[0] for c in result.description].index(n) for n in names]
    assert sorted(found.columns) == names
    assert sorted((tuple(r[c] for c in names) for r in found.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=repr)


@pytest.mark.skipif(not os.path.exists(TOKENIZERS), reason="no public vocabularies here")
def test_pipeline_equals_its_stages_by_brute_force(spark, documents, sql):
    texts = {i: t for i, t in sql.execute("SELECT doc_id, text FROM documents").fetchall() if any(c.isalpha() for c in t or "")}
    sql.execute("CREATE OR REPLACE TEMP VIEW leaks AS " + ORACLE_SQL["op5_decontamination"])
    leaks = {i for (i,) in sql.execute("SELECT doc_id FROM leaks").fetchall()}
    sql.execute("CREATE OR REPLACE TEMP TABLE lettered AS SELECT * FROM documents WHERE doc_id IN (SELECT unnest(?))", [list(texts)])
    near = jaccard_sql(5, 80).replace("from documents", "from lettered")
    component = {r[0]: r[1] for r in sql.execute(f"SELECT doc_id, component_id FROM ({near})").fetchall()}
    coder = bpe.automaton(vocabulary())
    want = {i: len(coder.encode(secrets.redacted(t))) // 4 for i, t in texts.items() if component[i] == i and i not in leaks}
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == want and len(rows) == len(want)
    assert all(len(r.token_ids) == r.n_tokens for r in rows)


def test_pipeline_drops_copies_that_share_four_fifths_of_five_word_shingles(spark, documents):
    words = [f"w{i}" for i in range(490)]
    changed = [f"n{i}" if i % 200 == 3 else w for i, w in enumerate(words)]
    texts = [" ".join(words[:400]), " ".join(words), " ".join(words[:300]), " ".join(changed[:400]), "other text of a few words", None]
    shingles = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in ((t or "").split() for t in texts)]
    root = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(shingles):
            for j, b in enumerate(shingles):
                if a and b and 10 * len(a & b) >= 8 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    assert root == [0, 0, 2, 0, 4, 5]
    kept = corpus_pipeline.drop_near_copies(spark, documents(*texts), SF_DIR).collect()
    assert sorted(r.doc_id for r in kept) == [0, 2, 4, 5]
