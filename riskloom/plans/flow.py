"""The whole flow as one driver function: generate, build features, train, gate, promote and score
or alert, and always expire old versions."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from riskloom import fixed_values as fv
from riskloom.plans.features import customer_risk_features, inference_input, labelled_spine, training_spine
from riskloom.plans.registry import Registry, send_alert, version_name
from riskloom.plans.scoring import fit_model, load_model, score_batch
from riskloom.schemas import RUNS
from riskloom.sources import tables
from riskloom.functions.times import clock

MODEL_NAME = "premium"


@dataclass(frozen=True)
class Layout:
    """Where a flow keeps its tables, under one shared root."""

    root: str

    @property
    def customers(self) -> str:
        return f"{self.root}/customers"

    @property
    def policies(self) -> str:
        return f"{self.root}/policies"

    @property
    def features(self) -> str:
        return f"{self.root}/features"

    @property
    def datasets(self) -> str:
        return f"{self.root}/datasets"

    @property
    def registry(self) -> str:
        return f"{self.root}/registry"

    @property
    def predictions(self) -> str:
        return f"{self.root}/predictions"

    @property
    def alerts(self) -> str:
        return f"{self.root}/alerts"

    @property
    def runs(self) -> str:
        return f"{self.root}/runs"

    def model(self, version: str) -> str:
        return f"{self.root}/models/{version}"


def run_flow(
    spark: SparkSession, root: str, customers: DataFrame, policies: DataFrame, *, year: int,
    as_of: datetime, rounds: int | None = None, depth: int | None = None,
    threshold: float = fv.GATE_THRESHOLD, expiry_days: int = fv.EXPIRY_DAYS,
) -> dict:
    """Run every step once and return what each of them reported."""
    at = Layout(root)
    tables.ensure_table(spark, at.runs, RUNS)
    registry = Registry(spark, at.registry)
    report: dict = {}
    error = None
    try:
        report["customers"] = tables.overwrite(customers, at.customers)
        report["policies"] = tables.overwrite(policies, at.policies)
        customers, policies = spark.read.parquet(at.customers), spark.read.parquet(at.policies)

        features = customer_risk_features(customers, policies, year=year, as_of=as_of)
        tables.overwrite(features, at.features)
        features = spark.read.parquet(at.features)

        version = spark.range(1).select(version_name(as_of)).first()[0]
        # One refresh holds all policies at once: the newest features are joined, openly without a point in time.
        training = labelled_spine(training_spine(policies, customers, year=year, keep=("policy_id",)), features)
        report["dataset"] = tables.write_dataset(training, at.datasets, "premium_training", version)

        training = tables.read_dataset(spark, at.datasets, "premium_training", version)
        model = fit_model(training, key="policy_id", rounds=rounds, depth=depth)
        path = model.save(at.model(version))
        registry.register(MODEL_NAME, version, model.metrics, artifact_path=path, at=as_of)
        report |= {"version": version, "metrics": model.metrics}

        report["decision"] = registry.check(MODEL_NAME, version, model.metrics, threshold=threshold)
        if report["decision"] == fv.PROMOTE:
            registry.promote(MODEL_NAME, version, at=as_of)
            production = load_model(spark, registry.default(MODEL_NAME)["artifact_path"])
            inputs = inference_input(policies, customers, features, year=year, keep=("policy_id",))
            report["predictions"] = score_batch(production, inputs, at.predictions, keep=("policy_id",))
        else:
            report["alert"] = send_alert(spark, at.alerts, version, model.metrics, at=as_of)
    except Exception as problem:
        error = str(problem)[:300]
        raise
    finally:
        report["expired"] = registry.expire(as_of=as_of, days=expiry_days)
        tables.insert_row(
            spark, at.runs, RUNS, name="premium_flow", state="FAILED" if error else "SUCCEEDED",
            scheduled_time=clock(as_of), completed_time=clock(None), error_message=error)
    return report
