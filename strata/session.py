"""Session helpers: a local builder for tests and bench, and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(app: str = "strata", cores: int | str = 8, **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench rely on (UTC, no web page)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="strata-wh-"))
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "64")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_fallback_root: str | None = None


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's shared folder (``spark.checkpoint.dir``).

    Where the session names none and runs in one process (a local test), a temporary
    folder of this process is used instead.
    """
    global _fallback_root
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _fallback_root is None:
            _fallback_root = tempfile.mkdtemp(prefix="strata-")
        root = _fallback_root
    return os.path.join(root, "strata", f"{label}-{uuid.uuid4().hex[:12]}")


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Run a block under changed session options and put the old ones back."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
