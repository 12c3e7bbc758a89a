"""Whole jobs, composed of the operators."""

from millrace.plans.bundle import Bundle, load_bundle, save_bundle, score_prepared, score_raw
from millrace.plans.churn import CHURN, ChurnPlan, run_churn
from millrace.plans.etl import (
    FLOW_ETL,
    EtlPlan,
    EtlRun,
    EtlState,
    apply_etl,
    clean,
    fit_etl,
    run_etl,
    run_etl_job,
    unpack_scaled,
)
from millrace.plans.training import TrainingPlan, TrainingResult, run_training, score_saved

__all__ = [
    "CHURN", "Bundle", "ChurnPlan", "EtlPlan", "EtlRun", "EtlState", "FLOW_ETL", "TrainingPlan", "TrainingResult",
    "apply_etl", "clean", "fit_etl", "load_bundle", "run_churn", "run_etl", "run_etl_job", "run_training",
    "save_bundle", "score_prepared", "score_raw", "score_saved", "unpack_scaled",
]
