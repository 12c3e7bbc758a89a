from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from millrace import plans, sources
from millrace.operators import features, learning
from millrace.workload.jobs import LINE_ETL, LINE_TRAINING
from millrace.workload.registry import dirty_lines

FLOW_ROWS = [
    # duration, forward, bytes, backward, rate, packets, label
    (500, 10, 5, 0, "Infinity", 1.0, "BENIGN "),
    (500, 10, 5, 0, "NaN", 1.0, " BENIGN"),
    (50_000, 8, 0, 4, 2.0, None, "DDoS"),
    (None, 1, 1, 1, 1.0, 1.0, "DDoS"),
]


@pytest.fixture(scope="module")
def flows(spark, tmp_path_factory):
    """Two days of flow files, with the same two rows in both."""
    folder = tmp_path_factory.mktemp("flows")
    schema = sources.flow_schema()
    places = [schema.names.index(c) for c in (
        "Flow Duration", "Total Fwd Packets", "Total Length of Fwd Packets", "Total Backward Packets",
        "Flow Bytes/s", "Flow Packets/s", "Label",
    )]
    lines = [",".join(f" {n}" for n in schema.names)]
    for row in FLOW_ROWS:
        fields = ["0"] * len(schema)
        for place, value in zip(places, row):
            fields[place] = "" if value is None else str(value)
        lines.append(",".join(fields))
    for day in ("Monday", "Tuesday"):
        (folder / f"{day}-WorkingHours.csv").write_text("\n".join(lines) + "\n")
    return sources.scan_csv(
        spark, str(folder), schema=schema, lineage_pattern=r"(\w+-WorkingHours)", enforceSchema="true"
    )


def test_flow_files_end_to_end(spark, flows, tmp_path):
    out = f"{tmp_path}/cleaned"
    state, report = plans.run_etl(flows, plans.FLOW_ETL, out, scale=True)
    assert {(r["is_attack"], r["row_count"]) for r in report.collect()} == {(0, 1), (1, 1)}
    rows = {r["Label"]: r for r in spark.read.parquet(out).collect()}
    benign, attack = rows["BENIGN"], rows["DDoS"]
    assert benign["Flow Bytes/s"] == 0.0 and benign["source_file"] == "Monday-WorkingHours"
    assert benign["pkt_byte_ratio"] == 2.0 and benign["fwd_bwd_ratio"] == 10.0
    assert attack["pkt_byte_ratio"] == 0.0 and attack["fwd_bwd_ratio"] == 2.0
    assert (benign["duration_bucket"], attack["duration_bucket"]) == ("very_short", "short")
    assert {benign["label_index"], attack["label_index"]} == {0.0, 1.0}
    assert "Fwd Header Length2" in rows["DDoS"].asDict()
    assert state.scales["Total Fwd Packets"].mean == 9.0 and "is_attack" not in state.scales
    summary = sources.scan_csv(spark, f"{out}_label_summary", schema="label string, flag int, n bigint")
    assert {tuple(r) for r in summary.collect()} == {("BENIGN", 0, 1), ("DDoS", 1, 1)}


def test_fitted_etl_applies_to_new_rows(spark):
    cleaned = plans.clean(dirty_lines(spark, SF_DIR), LINE_ETL)
    state = plans.fit_etl(cleaned, LINE_ETL)
    new = cleaned.limit(5).withColumn("label", F.lit("never seen"))
    with pytest.raises(Exception, match="label has no index"):
        plans.apply_etl(new, LINE_ETL, state).collect()
    kept = plans.apply_etl(new, replace(LINE_ETL, unlabelled="keep"), state)
    assert kept.select("label_index").distinct().first()[0] == state.labels.rows


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("trained")
    rows = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", F.lit("x").alias("label"),
        F.lit(0.0).alias("label_index"), (F.col("l_quantity") > 25).cast("int").alias("is_attack"),
    )
    result = plans.run_training(rows, LINE_TRAINING, f"{folder}/model", f"{folder}/predictions")
    return rows, result, str(folder)


def test_training_learns_a_learnable_rule(trained):
    _, result, _ = trained
    metrics = result.metrics.first()
    assert metrics["accuracy"] > 0.95 and metrics["auc"] > 0.98 and metrics["positive_f1"] > 0.95
    importance = {r["feature"]: r["importance"] for r in result.importance.collect()}
    assert sum(importance.values()) == pytest.approx(1.0)
    assert max(importance, key=importance.get) == "l_quantity"
    assert not set(importance) & {"is_attack", "l_orderkey", "label_index"}


def test_scoring_with_the_saved_model_repeats_the_predictions(spark, trained):
    rows, _, folder = trained
    written = spark.read.parquet(f"{folder}/predictions")
    keys = ["l_orderkey", "l_linenumber", "prediction", "probability_1"]
    scored = plans.score_saved(rows, LINE_TRAINING, f"{folder}/model")
    assert written.select(keys).exceptAll(scored.select(keys)).count() == 0
    assert 0 < written.count() < rows.count()
    assert scored.filter(~F.col("probability_1").between(0, 1)).count() == 0


def test_models_save_over_themselves_and_predictions_stay_outside(spark, trained):
    _, result, folder = trained
    learning.save_model(result.model, f"{folder}/model")
    assert learning.load_model(f"{folder}/model").getNumTrees == learning.FOREST["numTrees"]
    with pytest.raises(ValueError):
        learning.write_predictions(spark.range(1), f"{folder}/data/predictions", ["id"], data_set=f"{folder}/data")


def test_grid_search_covers_the_grid_and_refits_the_best(spark):
    rows = spark.range(400).select(
        (F.col("id") % 20).cast("double").alias("x"), ((F.col("id") % 20) > 9).cast("int").alias("y")
    )
    train = features.assemble(rows, ["x"])
    tree = learning.decision_tree(label="y")
    search, table = learning.grid_search(tree, {"maxDepth": (0, 3)}, train, "y", folds=2, fraction=None)
    found = {r["params"]: r["mean_auc"] for r in table.collect()}
    assert found["maxDepth=3"] == pytest.approx(1.0) and found["maxDepth=0"] == pytest.approx(0.5)
    assert learning.refit_best(tree, search, train).depth >= 1


def test_churn_customers(spark):
    plan = plans.CHURN
    base = spark.range(400).select(
        F.col("id").cast("string").alias("customerID"),
        *[F.concat(F.lit("v"), (F.col("id") + i) % 3).alias(c) for i, c in enumerate(plan.categorical)],
        (F.col("id") % 2).alias("SeniorCitizen"),
        (F.col("id") % 60).alias("tenure"),
        (F.col("id") % 100 + 0.5).cast("string").alias("MonthlyCharges"),
        F.when(F.col("id") % 40 == 0, " ").otherwise((F.col("id") % 90).cast("string")).alias("TotalCharges"),
        F.when((F.col("id") * 7919) % 60 > 25, "Yes").otherwise("No").alias("Churn"),
    )
    model, scored, metrics = plans.run_churn(base)
    assert len(model.stages) == 4
    assert scored.columns == ["customerID", "label", "prediction", "probability_1"]
    assert 0 < scored.count() < 390 and 0 <= metrics.first()["auc"] <= 1
