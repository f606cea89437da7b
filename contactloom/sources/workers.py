"""Python workers that find this package."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def importable(spark: SparkSession) -> None:
    """Let workers import the package from where the driver did, if they see that folder.

    On a cluster it is installed or handed over with ``--py-files``; this helps runs from a checkout.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([*paths, root])
