"""Session settings the jobs rely on, and the shared folder intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed semantics first, then plan quality. hugeMethodLimit: HotSpot never JIT-compiles a method above 8000
# bytecodes, so a fused stage over 50 columns and 87 rules would run interpreted; with the limit set to that
# number Spark falls back to per-operator generated code, which it splits into small methods.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "stayloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    # call-site capture doubles the cost of building a plan over many columns; it cannot be changed later
    static = {"spark.python.sql.dataFrameDebugging.enabled": "false"}
    for name, value in {**static, **SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return tune(builder.getOrCreate())


_local_folders: dict[str, str] = {}
_dropped_at_exit: set[str] = set()


def _drop_at_exit(spark: SparkSession, folder: str) -> None:
    """Have the folder of this application removed when its driver ends, whatever store it lies in."""
    if folder in _dropped_at_exit:
        return
    _dropped_at_exit.add(folder)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(path)
    store.deleteOnExit(path)


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a session that names none (tests, local runs) gets a temporary folder of its own.
    """
    app = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        folder = f"{configured.rstrip('/')}/stayloom/{app}"
        _drop_at_exit(spark, folder)
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="stayloom-")
        _drop_at_exit(spark, _local_folders[app])
    return _local_folders[app]


#: Bytes of a Parquet row group of staged tables. A writing task holds one, and whole texts fill large ones quickly.
ROW_GROUP = 32 << 20


def staged(df, label: str = "stage"):
    """Write a frame to the shared folder and read it back: cuts the lineage and fixes row placement for good."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/scratch/{label}-{uuid.uuid4().hex}"
    df.write.options(compression="zstd", **{"parquet.block.size": str(ROW_GROUP)}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)

