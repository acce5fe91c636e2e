"""The registered queries and the pipeline over the small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from conftest import SMALL
from oracle import duck

import corpus_pipeline
from tallylake.llm import bpe, queries, quality, secrets, simhash, sql, winnow


@pytest.fixture(scope="module")
def texts():
    return dict(duck(SMALL).execute("SELECT doc_id, text FROM documents").fetchall())


def test_every_operator_has_a_query():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in queries.queries()] == list(range(1, 14))
    assert set(sql.oracle_sql()) <= set(queries.queries())


def test_secret_query(spark, texts):
    for r in queries.op5_secret_scan(spark, SMALL).collect():
        base = secrets.in_order(secrets.base_spans(texts[r.doc_id]))
        kinds = Counter(k for k, _, _ in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r.base_sha256 == hashlib.sha256(secrets.joined(base).encode()).hexdigest()


def test_simhash_query(spark, texts):
    for r in queries.op7_simhash(spark, SMALL).collect():
        assert r.fingerprint == f"{simhash.fingerprint(texts[r.doc_id]):016x}"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, at = docs.columns, docs
    counts = [docs.count()]
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        rows = out.collect()
        at = spark.createDataFrame(rows, out.schema)
        kept.append({r.doc_id for r in rows})
        counts.append(len(rows))
    # Each stage against its operator over what the stage before kept.
    good = {r.doc_id for r in quality.quality_rules(docs).where("kept").collect()}
    assert kept[0] == good and kept[1] <= good
    found = simhash.near_duplicates(docs.where(docs.doc_id.isin(list(good)))).collect()
    assert len({r.group_fp for r in found}) == counts[2]
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    clean = docs.where(docs.doc_id.isin(list(kept[1])))
    hit = {r.doc_id for r in winnow.shared_spans(clean, items).where("size(spans) > 0").collect()}
    assert kept[2] == kept[1] - hit and kept[2] == kept[3] == kept[4]
    assert counts[0] > counts[1] and counts[3] > 0.5 * counts[0]
    for r in rows:
        assert not secrets.base_spans(r.text) and r.n_tokens == len(r.token_ids)
        assert r.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_run_is_the_stages(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert {"doc_id", "n_tokens", "token_ids"} <= set(found.columns) and found.count() > 100


def test_outputs_are_named(spark):
    assert queries.op9_bpe(spark, SMALL).columns[1:] == ["n_tokens", "ids_sha256", "decoded_sha256"]
    assert set(bpe.OUTPUTS) >= {"n_tokens", "token_ids"}
