"""Session defaults, and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "tallyspan", master: str | None = None, **conf) -> SparkSession:
    """A session with the defaults above. Keyword names use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): str(value) for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor can reach.

    Only a local-mode session may go without the setting; it then gets a temporary folder,
    remembered in the session so that later calls share it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = spark.conf.get("tallyspan.local.folder", None)
        if not base:
            base = tempfile.mkdtemp(prefix="tallyspan-")
            spark.conf.set("tallyspan.local.folder", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
