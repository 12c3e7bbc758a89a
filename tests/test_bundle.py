from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace import plans
from millrace.operators import features, learning
from millrace.operators.quality import Bounds
from millrace.plans import bundle
from millrace.plans.etl import EtlPlan

PLAN = plans.TrainingPlan(label="y", keys=("id",), forest={"numTrees": 5, "maxDepth": 4})


@pytest.fixture(scope="module")
def rows(spark):
    """Only ``a`` decides; in another order of columns the model would look at ``c``."""
    rows = spark.range(600).select(
        "id", (F.col("id") * 37 % 100).cast("double").alias("a"), (F.col("id") * 11 % 7).cast("int").alias("b"),
        (F.col("id") * 53 % 90).cast("bigint").alias("c"), F.lit("x").alias("label"),
    )
    return rows.withColumn("y", (F.col("a") > 50).cast("int"))


@pytest.fixture(scope="module")
def saved(rows, tmp_path_factory):
    folder = tmp_path_factory.mktemp("bundle")
    result = plans.run_training(rows, PLAN, f"{folder}/model", f"{folder}/predictions")
    return result, f"{folder}/model"


def predictions(scored):
    return {r["id"]: (r["prediction"], r["probability_1"]) for r in scored.collect()}


def test_inputs_are_taken_by_name_whatever_their_place(rows, saved):
    _, path = saved
    want = predictions(plans.score_saved(rows, PLAN, path))
    assert len(want) == 600 and sum(p[0] == float(i * 37 % 100 > 50) for i, p in want.items()) > 590
    swapped = rows.select("c", "y", "id", "b", "label", "a")
    assert predictions(plans.score_saved(swapped, PLAN, path)) == want
    extra = swapped.withColumn("a_first", F.lit(7.5)).select("a_first", "*", F.lit(3).alias("z"))
    scored = plans.score_saved(extra, PLAN, path)
    assert predictions(scored) == want and {"a_first", "z"} <= set(scored.columns)


def test_missing_and_textual_inputs_are_errors(rows, saved):
    _, path = saved
    with pytest.raises(KeyError, match="'b'"):
        plans.score_saved(rows.drop("b"), PLAN, path)
    with pytest.raises(TypeError, match="c is string"):
        plans.score_saved(rows.withColumn("c", F.col("c").cast("string")), PLAN, path)
    wider = rows.withColumn("b", F.col("b").cast("bigint"))
    assert plans.score_saved(wider, PLAN, path).count() == 600


def test_rows_with_gaps_are_left_out(rows, saved):
    gaps = rows.withColumn("a", F.when(F.col("id") % 3 != 0, F.col("a")))
    assert plans.score_saved(gaps, PLAN, saved[1]).count() == 400


def test_a_model_without_its_bundle_or_replaced_since(spark, rows, saved, tmp_path):
    result, _ = saved
    learning.save_model(result.model, f"{tmp_path}/alone")
    with pytest.raises(FileNotFoundError, match="without its inputs"):
        plans.score_saved(rows, PLAN, f"{tmp_path}/alone")
    plans.save_bundle(spark, plans.Bundle(result.model, bundle.inputs_of(rows, ["a", "b", "c"])), f"{tmp_path}/m")
    other = learning.decision_tree("f", "y").fit(features.assemble(rows, ["a"], "f"))
    learning.save_model(other, f"{tmp_path}/m")
    with pytest.raises(ValueError, match="saved for"):
        plans.load_bundle(spark, f"{tmp_path}/m")


def test_a_save_that_did_not_end_leaves_the_former_version(spark, rows, saved, tmp_path):
    result, _ = saved
    path = f"{tmp_path}/m"
    for names in (["a", "b", "c"], ["c", "b", "a"]):
        plans.save_bundle(spark, plans.Bundle(result.model, bundle.inputs_of(rows, names)), path)
        assert plans.load_bundle(spark, path).names == names
    half = spark.createDataFrame([(0, "z", "double")], bundle.INPUTS)
    half.write.parquet(f"{bundle.bundle_path(path)}/0123/inputs")
    assert plans.load_bundle(spark, path).names == ["c", "b", "a"]
    assert plans.load_bundle(spark, path).inputs == (("c", "bigint"), ("b", "int"), ("a", "double"))


ETL = EtlPlan(
    label="label", normal_label="x", duration="a", forward="b", forward_bytes="c", backward="b", rates=("c",),
    thresholds=(10,), bucket_names=("low", "high"), exact_bounds=True, unlabelled="keep",
)


def test_what_the_job_learned_comes_back(spark, rows, tmp_path):
    source = rows.withColumn("label", F.when(F.col("id") % 4 == 0, " w ").otherwise("x")).withColumn("c", F.col("c") + 0.5)
    run = plans.run_etl_job(source, ETL, f"{tmp_path}/data", scale=True)
    written = spark.read.parquet(f"{tmp_path}/data")
    training = plans.TrainingPlan(label="is_attack", keys=("id",), exclude=("label_index", "y"), forest={"numTrees": 3})
    plans.run_training(written, training, f"{tmp_path}/model", f"{tmp_path}/predictions", run.state)
    again = plans.load_bundle(spark, f"{tmp_path}/model")
    assert again.state.bounds == run.state.bounds and isinstance(again.state.bounds["a"], Bounds)
    assert again.state.scales == run.state.scales and list(again.state.scales) == list(run.state.scales)
    assert sorted(map(tuple, again.state.labels.table.collect())) == sorted(map(tuple, run.state.labels.table.collect()))
    want = predictions(plans.score_prepared(written, again))
    raw = source.select(*reversed(source.columns)).withColumn("more", F.lit(1))
    assert predictions(plans.score_raw(raw, ETL, again)) == want and len(want) == 600
    far = source.filter("id < 5").withColumn("a", F.lit(1e9))
    assert {r["a"] for r in plans.score_raw(far, ETL, again).collect()} == {run.state.bounds["a"].upper}


def test_raw_rows_need_the_state_of_the_job(rows, saved, spark):
    with pytest.raises(ValueError, match="no ETL state"):
        plans.score_raw(rows, ETL, plans.load_bundle(spark, saved[1]))
