"""The registered corpus queries: their columns, their SQL, and the pipeline."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
import corpus_pipeline
from strata.llm import queries
from tests.conftest import SF_SMALL
from tests.llm import brute

COLUMNS = {  # as the contract has them
    "op2_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
                "base_sha256": "string", "spans": "string"},
    "op3_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op4_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int",
                     "slot": "bigint", "grown_shard": "int"},
    "op5_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op6_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op7_decontamination": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint",
                            "items_sha256": "string", "contaminated": "boolean"},
    "op8_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op9_top_k": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op10_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op11_periodic_runs": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
                           "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"},
    "op12_collocations": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint",
                          "n": "bigint", "score": "bigint"},
    "op13_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
}


def test_all_are_registered():
    found = entry_mod.queries()
    assert {n for n in found if n.startswith("op")} == set(queries.QUERIES)
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert found["pipeline"] is corpus_pipeline.run
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES) and set(queries.ORACLE_SQL) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_are_the_contracts(result, name):
    assert result(name).dtypes == COLUMNS[name]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(result, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_SMALL}/{table}.parquet')")
    names = result(name).columns
    found = duck.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert Counter(map(tuple, result(name).rows)) == Counter(found)


# pipeline ------------------------------------------------------------------

def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]


def _check_run(spark, docs, sf_dir, rows):
    """Each stage against its plain version; returns the last one's rows."""
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["language_id"](spark, docs, sf_dir)
    assert kept.columns == docs.columns
    left = sorted((r.doc_id for r in kept.select("doc_id").collect()), key=str)
    assert left == sorted((i for i, t in rows if any(c.isalpha() for c in t or "")), key=str)
    rows = [tuple(r) for r in kept.select("doc_id", "text").collect()]

    kept = stages["near_dedup"](spark, kept, sf_dir)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == brute.kept_ids(rows)
    rows = [tuple(r) for r in kept.select("doc_id", "text").collect()]

    kept = stages["decontamination"](spark, kept, sf_dir)
    assert kept.columns == docs.columns
    clean = [r[0] for r in brute.contamination(rows, items) if not r[-1]]
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == Counter(clean)

    mixed = stages["mixing"](spark, kept, sf_dir)
    assert mixed.columns == docs.columns
    assert set(r.doc_id for r in mixed.select("doc_id").collect()) == set(clean)
    texts = [tuple(r) for r in mixed.select("doc_id", "text").collect()]

    placed = stages["sharding"](spark, mixed, sf_dir).collect()
    assert Counter((r.doc_id, r["size"]) for r in placed) == Counter((i, len((t or "").encode()) + 8) for i, t in texts)
    return placed


def test_pipeline_stages_on_the_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    placed = _check_run(spark, docs, SF_SMALL, rows)
    run = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert Counter(map(tuple, run)) == Counter(map(tuple, placed))


def test_pipeline_stages_on_odd_rows(spark, odd_docs, odd_rows, no_docs):
    _check_run(spark, odd_docs.filter("doc_id is not null"), SF_SMALL, [r for r in odd_rows if r[0] is not None])
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, odd_docs, SF_SMALL).collect()
        assert stage(spark, no_docs, SF_SMALL).count() == 0


def test_mixed_stream_is_laid_out_in_order(spark):
    from strata.llm import mixing

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "source")
    laid = mixing.in_stream_order(mixing.mix(docs, block=4)).withColumn("part", F.spark_partition_id())
    rows = laid.select("part", "slot", "rank").collect()
    assert [(r.slot, r["rank"]) for r in rows] == sorted((r.slot, r["rank"]) for r in rows)
