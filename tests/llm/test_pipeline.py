"""The pipeline's stages against brute force, and the SQL of registered queries."""

import os

import duckdb
import pytest

import corpus_pipeline
from tillwise.llm import minhash, queries
from tillwise.llm.common import table

SF = "/root/testdata/sf0.001"


def test_every_dealt_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    import __spark_entry__ as entry

    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLE[name])
    cols = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_stages_one_by_one(spark, tmp_path):
    from .test_dedup import words_removed

    docs, tables = table(spark, SF, "documents"), []
    names = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = os.path.join(tmp_path, name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        tables.append(docs)
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == names
    start = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    good, near, cut, mixed, packed = ([r for r in t.collect()] for t in tables)
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    stay = {r.doc_id for r in good}
    assert sum((d in stay) == bool(q) for d, q in labels.items() if d in start) >= 0.95 * len(labels)
    assert all(r.text == start[r.doc_id] for r in good)
    sets = [(r.doc_id, minhash.shingles(r.text.encode(), 5)) for r in good]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, u in sets[:i]:
            if s and u and 100 * len(s & u) >= 80 * len(s | u):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert {r.doc_id for r in near} == {find(d) for d in parent}
    removed = {d: (n, gone) for d, n, gone, _ in words_removed([(r.doc_id, r.text.encode()) for r in near])}
    assert {r.doc_id: len(r.text.encode().split()) for r in cut} == {d: n - gone for d, (n, gone) in removed.items()}
    assert all(r.n_chars == len(r.text) for r in cut)
    words = sum(len(r.text.encode().split()) for r in cut)
    assert abs(sum(len(r.text.encode().split()) for r in mixed) - 1.5 * words) < 0.2 * words
    assert {(r.doc_id, r.text) for r in mixed} <= {(r.doc_id, r.text) for r in cut}
    assert sorted(r.doc_id for r in packed if r.piece == 0) == sorted(r.doc_id for r in mixed)


def test_stages_take_edge_cases_and_empty_tables(spark, docs, none, clashing, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows, clashing names, no rows."""
    for case, frame in (("none", none), ("clashing", clashing)):
        start, sizes = frame, []
        for name, stage in corpus_pipeline.STAGES:
            path = os.path.join(tmp_path, case, name)
            stage(spark, frame, SF).write.parquet(path)
            frame = spark.read.parquet(path)
            sizes.append(frame.count())
            assert name == corpus_pipeline.STAGES[-1][0] or frame.columns == start.columns, (case, name)
        assert (case == "none") == (sizes == [0] * len(sizes)), sizes
        assert sizes[1] <= sizes[0] <= start.count() and sizes[2] == sizes[1]
