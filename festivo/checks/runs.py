"""Runs that queries of one session share, so that their staged inputs are written once."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

from festivo.checks.registry import CFG
from festivo.config import RunConfig
from festivo.plans.model import ModelRun
from festivo.plans.upload import UploadRun
from festivo.sources.retail import Retail
from festivo.sources.tables import stage, staging_root

_RUNS: dict[tuple, Any] = {}


def shared(kind: str, spark: SparkSession, root: str, cfg: RunConfig, make: Callable[[], Any]) -> Any:
    """One object per session, staging folder, table folder and configuration."""
    key = (kind, spark.sparkContext.applicationId, staging_root(spark), root, repr(cfg))
    if key not in _RUNS:
        _RUNS[key] = make()
    return _RUNS[key]


def forget_runs() -> None:
    """Start anew: the next query derives and stages its inputs itself."""
    _RUNS.clear()


def retail(spark: SparkSession, root: str, cfg: RunConfig = CFG) -> Retail:
    return shared("retail", spark, root, cfg, lambda: Retail(spark, root, cfg))


def model(spark: SparkSession, root: str, cfg: RunConfig = CFG) -> ModelRun:
    return shared("model", spark, root, cfg, lambda: ModelRun(retail(spark, root, cfg)))


def upload(spark: SparkSession, root: str, cfg: RunConfig = CFG) -> UploadRun:
    """Upload run over the stand-in targets and clusters."""

    def make() -> UploadRun:
        r = retail(spark, root, cfg)
        return UploadRun(r, lambda: stage(r.event_targets, "targets"), lambda: stage(r.sales_clusters, "clusters"), r.this_week_hours)

    return shared("upload", spark, root, cfg, make)
