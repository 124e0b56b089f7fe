from __future__ import annotations

from pathlib import Path

import pytest

import corpus_pipeline
from check import compare, connect

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A small folder in which the pipeline has something to do at every stage."""
    folder = tmp_path_factory.mktemp("tables")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, tables).cache()
        assert kept.columns == columns and dict(kept.dtypes) == dict(docs.dtypes)
        assert ids(kept) <= ids(docs)
        if name == "line_dedup":
            assert ids(kept) == ids(docs)
            assert all(r.n_chars == len(r.text) for r in kept.collect())
        docs = kept
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, tables)
    assert ids(pieces) == ids(docs)


def test_odd_rows(spark, rows, tables):
    schema = spark.read.parquet(f"{tables}/documents.parquet").schema
    clean = spark.read.parquet(f"{tables}/documents.parquet").where("n_chars > 400").limit(1).first()
    data = [(None, clean.text, "en", None, 1), (1, None, None, None, None), (2, "", "en", "s", 0), (3, clean.text, "en", "s", 1),
            (3, clean.text, "en", "s", 1), (4, clean.text, "de", "s", 1), (5, clean.text + "!", "de", "s", 1)]
    docs = spark.createDataFrame(data, schema)
    kept = corpus_pipeline.one_of_each(spark, docs, tables).collect()
    assert sorted((r.doc_id is not None, r.doc_id) for r in kept if r.doc_id) == [(True, 1), (True, 2), (True, 3)]
    assert sum(r.doc_id is None for r in kept) == 1
    nothing = docs.where("doc_id > 99")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, tables).count() == 0
        assert stage(spark, docs, tables).count() >= 0


def test_rows_that_share_an_id_are_documents_of_their_own(spark, rows):
    words = lambda c: " ".join(f"{c}{i}" for i in range(40))
    x, y, z = map(words, "xyz")
    data = [(3, x, "s"), (5, x.upper(), "s"), (5, y, "a"), (5, y, "b"), (0, z, "s"), (0, words("v"), "s"), (0, words("w"), "s"),
            (7, z + " more", "s"), (0, words("w") + " more", "s"), (8, "", "s"), (8, "?", "s")]
    kept = corpus_pipeline.one_of_each(spark, rows(data, "doc_id INT, text STRING, source STRING"), "").collect()
    got = sorted((r.doc_id, r.text) for r in kept)
    w = [t for i, t in got if i == 0 and t.startswith("w")]
    assert len(w) == 1 and w[0].startswith(words("w"))
    assert [g for g in got if g[1] != w[0]] == sorted([(3, x), (5, y), (0, z), (0, words("v")), (8, ""), (8, "?")])


def test_run_is_the_stages_in_order(spark, tables):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontaminate", "packing"]
    assert entry.queries()["pipeline"](spark, tables).count() > 0


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_query_equals_its_sql(spark, name):
    assert compare(entry.queries()[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name]).startswith("ok")


def test_run_equals_brute_force(spark, tables):
    """Every stage once more in plain Python, from the same model of quality to the pieces."""
    import zlib
    from array import array

    import numpy as np
    from test_decontaminate import brute_force as hits
    from test_line_dedup import brute_force as without_lines
    from test_near_dup import brute_force as classes
    from test_packing import reference

    from airlake.llm import quality
    from airlake.llm.packing import pieces_of
    from airlake.llm.queries import fold

    docs = spark.read.parquet(f"{tables}/documents.parquet")
    labels = spark.read.parquet(f"{tables}/labels.parquet").where(fold() != 2)
    model = quality.train(docs, labels)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())

    def score(text):
        (ids, weights), = quality.bags([(text or "").encode()])
        v = model.vector(ids, weights)
        cosines = model.vectors @ (v / (np.linalg.norm(v) or 1))
        least = np.sort(cosines)[-min(model.neighbours, len(cosines))]
        votes = [(max(float(c), 0) ** 4, y) for c, y in zip(cosines, model.labels) if c >= least - quality.TIED]
        total = sum(w for w, _ in votes)
        return sum(w * y for w, y in votes) / total if total else model.prior

    rows = [(i, t) for i, t in rows if score(t) >= quality.THRESHOLD]
    rows = [(i, kept) for (i, _), (kept, _, _) in zip(rows, without_lines([t for _, t in rows]))]
    chosen = classes(rows)
    rows = [(i, t) for i, t in rows if chosen.get(i, i) == i]
    items = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(i, t) for (i, t), (_, n_hit, _, _) in zip(rows, hits([t for _, t in rows], items)) if not n_hit]
    encode, want = reference(), set()
    for i, text in rows:
        ids = [*encode(text or ""), 0]
        at = 0
        for n in pieces_of(np.array([len(ids)]))[1].tolist():
            want.add((i, at, n, zlib.crc32(array("I", ids[at : at + n]).tobytes()), len(ids)))
            at += n
    got = {(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in corpus_pipeline.run(spark, tables).collect()}
    assert got == want and len({i for i, _ in rows}) < docs.count()
