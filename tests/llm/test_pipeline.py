import zlib

import numpy as np
import pytest

import corpus_pipeline as cp
from encore.llm import quality, queries
from tests.llm import helpers as h
from tests.llm.test_tokens import crc, library_ids
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_sql(spark, key):
    ok, _, _, _, detail = compare(spark, duck(SF), key, queries.QUERIES[key], queries.ORACLE_SQL[key], SF)
    assert ok, detail


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in quality.score(docs, model).where("predicted = 1").collect()}
    rows = [r for r in sorted(docs.collect(), key=lambda r: r.doc_id) if r.doc_id in good]
    ids = [r.doc_id for r in rows]
    stays = h.components([h.fingerprint(r.text) for r in rows], ids, 2)
    rows = [r for r, c in zip(rows, stays) if r.doc_id == c]
    texts = [k if n else r.text for r, (_, n, k) in zip(rows, h.repeats([r.text for r in rows], 35))]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = [(r.doc_id, t) for r, t, found in zip(rows, texts, h.contained(texts, items)) if not found]
    want = []
    for i, t in left:
        mine = [*library_ids(t), 0]
        cuts = [0, *range((len(mine) - 1) % 2048 + 1, len(mine) + 1, 2048)]
        want += [(i, p, a, b - a, crc(mine[a:b])) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
    got = cp.run(spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want


def test_stages_keep_the_documents_columns_and_take_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(60))
    texts = [None, "", text, text, text + " more", "plain words"]
    docs = h.documents(spark, texts, [None, 1, 2, 2, None, 4])
    for table in (docs, docs.limit(0)):
        for name, stage in cp.STAGES[:-1]:
            found = stage(spark, table, SF)
            assert found.columns == docs.columns, name
            assert found.count() <= table.count()
        cp.STAGES[-1][1](spark, table, SF).collect()
    clashing = docs.selectExpr("*", "1 __row", "2 __n", "3 predicted", "4 n_words", "5 __text", "6 piece")
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, clashing, SF).columns == docs.columns, name
    assert cp.STAGES[-1][1](spark, clashing, SF).count() == len(texts)
    kept = cp.simhash_near_dedup(spark, docs, SF).collect()
    assert sum(r.doc_id == 2 for r in kept) == 1
    cut = {r.n_chars: r.text for r in cp.substring_dedup(spark, docs.where("doc_id = 2 or doc_id = 4"), SF).collect()}
    assert cut == {0: "", 11: "plain words"}
