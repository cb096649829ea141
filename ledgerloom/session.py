"""Sessions: sensible settings, and the package on every executor."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_own: dict[str, str] = {}


def session(name: str = "ledgerloom", **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC dates and skew handling on."""
    builder = SparkSession.builder.appName(name)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    return builder.config(map=base | {k.replace("_", "."): v for k, v in conf.items()}).getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package: unless PYTHONPATH has it, Spark serves a zip of it."""
    root = Path(__file__).resolve().parent
    places = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    app = spark.sparkContext.applicationId
    if str(root.parent) not in places and app not in _shipped:
        path = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session's ``spark.checkpoint.dir`` names it.
    Where that is unset, a temporary folder of a local session; on a cluster there is no such thing."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
    return _own[app]


def cut(df: DataFrame) -> DataFrame:
    """The same rows from a checkpoint in the shared folder: what made them is not run again."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint()
