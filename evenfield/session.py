"""Sessions for tests and local runs, and shipping the package to executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session on this machine with the settings that tests and the bench use."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
    } | conf
    spark = SparkSession.builder.master(f"local[{cores}]").appName("evenfield").config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors see: under ``spark.checkpoint.dir``, or on this machine where the master is local."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Gives executors this package's modules, whatever their working directory; once an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    fd, target = tempfile.mkstemp(prefix="evenfield-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, f"{root.name}/{path.relative_to(root)}")
    context.addPyFile(target)
    _shipped.add(context.applicationId)
