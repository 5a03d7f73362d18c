"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a crowded key is split even where that costs a later stage another shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # building a wide aggregate makes thousands of column calls; do not record a stack for each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "riskengine", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` when the cluster
    names one, else (tests, a laptop) a temporary folder of this machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    fallback = os.path.join(tempfile.gettempdir(), f"riskengine-{os.getpid()}")
    os.makedirs(fallback, exist_ok=True)
    return fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers once per application, so that tasks can import it
    wherever the workers run."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="riskengine-"), "riskengine.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _dirs, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("riskengine", os.path.relpath(full, here)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)
