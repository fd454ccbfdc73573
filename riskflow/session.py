"""Session helpers: a local session for tests/bench and the shared scratch folder.

On a cluster the scratch folder is whatever the cluster names in
``spark.checkpoint.dir``; only when that is unset (local tests) do we create one.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


#: Stage tables written, by application.
_STAGES: dict[str, list[str]] = {}
_SHIPPED: set[str] = set()


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "riskflow") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("RISKFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_dir(spark)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written stages.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir); sets a fresh
    local folder only when none is configured and the master is local, which is the
    test/bench case. On a cluster without the setting it raises.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        d = tempfile.mkdtemp(prefix="riskflow-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python workers can import it wherever the
    driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="riskflow-ship-"), "riskflow.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("riskflow", os.path.relpath(full, here)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut the lineage by writing ``df`` as a Parquet table in the shared checkpoint folder and reading it back.

    Like a reliable ``checkpoint()`` it survives executor loss (no recomputation from the sources), and in
    addition later stages read only the columns they use and push filters into the scan. ``stage_path`` tells the path.
    """
    spark = df.sparkSession
    path = os.path.join(scratch_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    _STAGES.setdefault(spark.sparkContext.applicationId, []).append(path)
    out = spark.read.parquet(path)
    out.stage_path = path  # of this very table; what is derived from it has none
    return out


def stage_path(df: DataFrame) -> str | None:
    """The path of a stored stage as ``cut_lineage`` returned it; None for any other table."""
    return df.__dict__.get("stage_path")


def drop_stages(spark: SparkSession) -> int:
    """Delete the stage tables that ``cut_lineage`` has written in this session; returns how many. For callers that are
    done with every result that reads them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _STAGES.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)
