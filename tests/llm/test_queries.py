"""Contract queries and pipeline stages on the test tables."""

import duckdb
import pytest
from compare import rows_of
from conftest_tables import SF_DIR, TABLES
from pyspark.sql import functions as F

import corpus_pipeline
from quotelake.llm import decontamination, quality, secrets, simhash_sets
from quotelake.llm.common import table
from quotelake.llm.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    frame = found.toPandas()
    source = {"op1": "pages", "op12": "embeddings"}.get(name.split("_")[0], "documents")
    key = {"pages": "page_id", "embeddings": "vec_id"}.get(source, "doc_id")
    if key in frame:
        assert set(frame[key]) == {r[key] for r in table(spark, SF_DIR, source).select(key).collect()}
    if name in ORACLES:
        duck = duckdb.connect()
        for t in TABLES:
            duck.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
        assert rows_of(frame) == rows_of(duck.execute(ORACLES[name]).fetch_df())


def test_pipeline_stages(spark):
    """Each stage does to its own input what its operator says of it."""
    docs = table(spark, SF_DIR, "documents").cache()
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    stages = dict(corpus_pipeline.STAGES)

    judged = quality.judge(docs, table(spark, SF_DIR, "labels"))
    good = stages["quality_classifier"](spark, docs, SF_DIR).cache()
    assert ids(good) == ids(judged.filter("keep")) and good.columns == docs.columns

    groups = simhash_sets.near_groups(good)
    single = stages["simhash_near_dedup"](spark, good, SF_DIR).cache()
    assert ids(single) == ids(groups.filter("doc_id = component_id")) and single.columns == docs.columns

    hit = decontamination.find_windows(single, table(spark, SF_DIR, "benchmark"))
    clean = stages["benchmark_decontamination"](spark, single, SF_DIR).cache()
    assert ids(clean) == ids(hit.filter(F.size("hits") == 0)) and clean.columns == docs.columns

    masked = stages["secret_scans"](spark, clean, SF_DIR).cache()
    assert ids(masked) == ids(clean) and masked.columns == docs.columns
    assert secrets.scan_secrets(masked).filter(F.size("spans") > 0).count() == 0

    packed = stages["sequence_packing"](spark, masked, SF_DIR)
    assert ids(packed) == ids(masked)
    assert ids(corpus_pipeline.run(spark, SF_DIR)) == ids(masked)
