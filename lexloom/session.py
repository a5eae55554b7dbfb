"""Session settings and shared scratch space.

Everything that must outlive a stage goes to the folder named by
``spark.checkpoint.dir``; only where that is unset (local tests) is a folder of
our own chosen.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}
_STAGED: dict[str, list[str]] = {}


def build_session(app: str = "lexloom", master: str = "local[*]", partitions: int = 8, **conf: str) -> SparkSession:
    """A session with UTC, ANSI and adaptive execution, for tests and benches."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="lexloom-")
        atexit.register(shutil.rmtree, _LOCAL_SCRATCH[app], ignore_errors=True)
        spark.sparkContext.setCheckpointDir("file://" + _LOCAL_SCRATCH[app])
    return "file://" + _LOCAL_SCRATCH[app]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage as ``checkpoint()`` does, but compressed, with pruned
    columns, and with file sizes that the planner can trust when it chooses
    between a broadcast and a shuffled join. Survives the loss of executors.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, name: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def unstage(*staged: DataFrame) -> None:
    """Delete the files behind staged tables that no later plan reads."""
    for df in staged:
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            _delete(df.sparkSession, name)


def release(spark: SparkSession) -> None:
    """Delete all tables this application has staged; to be called once its results are written, for until then they are read."""
    for path in _STAGED.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)
