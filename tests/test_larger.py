"""Queries on rows that only larger tables hold, and what their plans shuffle."""

import os

import duckdb
import numpy as np
import pytest

from utterframe import fixtures as fx
from utterframe.plans import catalog


def test_window_mean_multiplies_in_single_precision(spark, tmp_path):
    """Values whose product with 1000 ends in .5 in single precision only."""
    x = np.arange(1, 400_000, dtype=np.float64).astype(np.float32) / np.float32(4e5)
    single, double = np.trunc(x * np.float32(1000) + np.float32(0.5)), np.trunc(x.astype(np.float64) * 1000 + 0.5)
    odd = x[single != double][:64]
    assert len(odd) == 64
    path = tmp_path / "embeddings.parquet"
    spark.createDataFrame([(1, odd.tolist()), (2, (-odd[:20]).tolist()), (3, odd[:5].tolist())], "vec_id long, embedding array<float>").coalesce(1).write.parquet(str(path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/*.parquet'")
    want = sorted(con.execute(catalog.ORACLE_SQL["window_mean"]).fetchall())
    assert sorted(tuple(r) for r in catalog.QUERIES["window_mean"](spark, str(tmp_path)).collect()) == want


SF = "/root/testdata/sf0.001"
#: Exchanges of a query's plan: the documents' one, before they become words, and those of what is far smaller.
EXCHANGES = {
    "rechunk": 1,
    "drop_untimed": 1,
    "transcript": 2,
    "clip_words": 2,
    "assign_speakers": 2,
    "assign_speakers_nearest": 6,
    "word_overlap_flag": 4,
    "dedup_seams": 1,
    "merge_superchunks": 1,
    "pack_sentences": 1,
    "min_duration": 1,
    "rechunk_by_speaker": 1,
}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", EXCHANGES)
def test_words_are_not_shuffled(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= EXCHANGES[name], plan
    above: list[tuple[int, str]] = []  # the nodes that a line of the plan stands under
    for line in plan.splitlines():
        depth = max(line.find("+- "), line.find(":- "))
        if depth < 0:
            continue
        above = [*(x for x in above if x[0] < depth), (depth, line)]
        if "Generate posexplode(split(" in line and name != "assign_speakers_nearest":  # which deals words far from any turn
            assert not any("Exchange " in x for _, x in above), plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["time_shift", "clip_words", "transcript", "segments_with_source"])
def test_words_stay_where_what_they_meet_is_too_large_to_broadcast(spark, name):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    above: list[tuple[int, str]] = []
    for line in plan.splitlines():
        depth = max(line.find("+- "), line.find(":- "))
        if depth < 0:
            continue
        above = [*(x for x in above if x[0] < depth), (depth, line)]
        if "Generate posexplode(split(" in line:
            assert not any("Exchange " in x or "SortMergeJoin" in x for _, x in above), plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["dedup_seams", "merge_superchunks"])
def test_columns_that_nobody_reads_dont_pass_through_python(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SPK_" not in plan


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_a_part_of_words_holds_some_2_mb_of_stored_documents(spark):
    assert fx.words(spark, "/root/testdata/sf0.1", by_video=True)._jdf.rdd().getNumPartitions() >= 7
