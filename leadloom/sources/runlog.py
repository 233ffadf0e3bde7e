"""Run tracking as three append-only tables: runs, params, metrics."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.sources.store import Store

SCHEMAS = {
    "runs": "run_id string, experiment string, run_name string, started timestamp, status string",
    "params": "run_id string, key string, value string",
    "metrics": "run_id string, key string, value double",
}


@dataclass
class Run:
    """Collects what a run logs and appends it once, when the run ends."""

    log: RunLog
    run_id: str
    experiment: str
    name: str
    started: datetime
    params: dict[str, str] = field(default_factory=dict)
    metrics: list[tuple[str, float]] = field(default_factory=list)

    def log_param(self, key: str, value: object) -> None:
        if key in self.params and self.params[key] != str(value):
            raise ValueError(f"parameter {key} is already set")
        self.params[key] = str(value)

    def log_metric(self, key: str, value: float) -> None:
        self.metrics.append((key, float(value)))

    def log_model(self, name: str, model: PipelineModel, features: list[str]) -> None:
        Store(self.log.spark, self.log.root).put_model(f"{self.run_id}-{name}", model, features)
        self.log_param(f"model.{name}", f"{self.run_id}-{name}")

    def __enter__(self) -> Run:
        return self

    def __exit__(self, kind: type | None, *_rest: object) -> None:
        status = "FINISHED" if kind is None else "FAILED"
        self.log.append("params", [(self.run_id, k, v) for k, v in self.params.items()])
        self.log.append("metrics", [(self.run_id, k, v) for k, v in self.metrics])
        self.log.append("runs", [(self.run_id, self.experiment, self.name, self.started, status)])


@dataclass(frozen=True)
class RunLog:
    spark: SparkSession
    root: str

    def start_run(self, experiment: str, name: str, started: datetime | None = None) -> Run:
        return Run(self, uuid.uuid4().hex, experiment, name, started or datetime.now(timezone.utc))

    def append(self, table: str, rows: list[tuple]) -> None:
        if rows:
            self.spark.createDataFrame(rows, SCHEMAS[table]).coalesce(1).write.mode("append").parquet(
                f"{self.root.rstrip('/')}/{table}")

    def read(self, table: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[table]).parquet(f"{self.root.rstrip('/')}/{table}")

    def get_params(self, run_id: str) -> dict[str, str]:
        """What one run logged as parameters, a few short strings."""
        return {r["key"]: r["value"] for r in self.read("params").filter(F.col("run_id") == run_id).collect()}

    def get_model(self, run_id: str, name: str) -> tuple[PipelineModel, list[str]]:
        """A model that a run logged, and the features it reads."""
        return Store(self.spark, self.root).get_model(self.get_params(run_id)[f"model.{name}"])
