"""Session helpers: building a local session for tests/bench, and the shared
checkpoint folder used to cut lineage in iterative operators."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()

def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "curlew") -> SparkSession:
    """A local session configured the way the operators expect (AQE on,
    UI off). On a cluster, build the session yourself; nothing here is
    required by the operators."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster, ``spark.checkpoint.dir`` names a shared folder and is used
    as is; without it the executors have no folder in common, so this raises.
    Only a session whose executor is the driver (local tests) gets a scratch
    folder of its own.
    """
    sc = spark.sparkContext
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    jdir = sc._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get()
    if not conf_dir:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="curlew-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc._jsc.sc().getCheckpointDir().get()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors' Python workers, once a session, so that
    its functions can be imported there whatever their working folder."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parent
    at = Path(tempfile.mkdtemp(prefix="curlew-pkg-")) / "curlew_pkg.zip"
    with zipfile.ZipFile(at, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    sc.addPyFile(str(at))
    _shipped.add(sc.applicationId)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives
    executor loss, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
