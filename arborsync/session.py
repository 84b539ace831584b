"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings the jobs are planned for. On a cluster they belong in the submit
# configuration; build_session() applies them for local runs and tests.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lookup joins rely on it for hot keys, at the price of a further shuffle where one is needed.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Rows of the content scan may hold megabytes each.
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    "spark.ui.enabled": "false",
}

_local_work_dirs: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app: str = "arborsync", cores: int | str = "*", **conf: str) -> SparkSession:
    """Local session for tests, the bench and small runs."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {**JOB_CONF, "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"}
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they find it wherever the driver runs."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="arborsync-")) / "arborsync.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as held:
        for source in sorted(package.rglob("*.py")):
            held.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def work_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, the one the cluster names in spark.checkpoint.dir.

    Only a local master without that setting gets a temporary folder: on a
    cluster executors would not see it.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    app_id = spark.sparkContext.applicationId
    if app_id not in _local_work_dirs:
        _local_work_dirs[app_id] = tempfile.mkdtemp(prefix="arborsync-")
    return _local_work_dirs[app_id]


def new_work_path(spark: SparkSession, label: str) -> str:
    """Fresh path under this application's part of the work folder."""
    app_id = spark.sparkContext.applicationId
    return f"{work_root(spark)}/arborsync/{app_id}/{label}-{uuid.uuid4().hex}"


def clear_work(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application (call once its results are written)."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(
        f"{work_root(spark)}/arborsync/{spark.sparkContext.applicationId}"
    )
    filesystem = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    filesystem.delete(folder, True)
