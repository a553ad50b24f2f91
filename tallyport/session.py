"""Session settings that every job of this library relies on."""

from __future__ import annotations

import tempfile
import threading
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource

#: Fixed by the data model: UTC text <-> instant, ANSI arithmetic, TIME columns, runtime re-planning.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that change results (never those that size a cluster)."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "tallyport", master: str | None = None, **conf: str) -> SparkSession:
    """A session with REQUIRED settings; `conf` (dots as double underscores) adds to them."""
    builder = SparkSession.builder.appName(app).config(map=REQUIRED)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the cluster names. A temporary one is made only where driver and executors are one
    process (tests); on a cluster none would be shared, so there it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = Path(tempfile.mkdtemp(prefix="tallyport-")).as_uri()
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame, name: str) -> DataFrame:
    """`df` written as a table in the shared folder and read again: ends its lineage, survives lost executors."""
    df.write.parquet(path := f"{shared_folder(df.sparkSession).rstrip('/')}/tallyport/{name}-{uuid.uuid4().hex}")
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that `cut` wrote, once nothing reads them any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._cut_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: Loads that run at once prepare a context and a session one after the other: a second file of the same name is refused, and
#: so is a data source that another thread registers just then.
_PREPARING = threading.Lock()


def ship(spark: SparkSession) -> None:
    """Send this library to the Python workers, once a context: they may not have it installed."""
    context = spark.sparkContext
    with _PREPARING:
        if getattr(context, "_tallyport_shipped", False):
            return
        root = Path(__file__).parent
        bundle = Path(tempfile.mkdtemp(prefix="tallyport-")) / "tallyport.zip"
        with zipfile.ZipFile(bundle, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        context.addPyFile(str(bundle))
        context._tallyport_shipped = True


def register(spark: SparkSession, source: type[DataSource]) -> None:
    """Make a data source known to a session, once."""
    with _PREPARING:
        known = spark.__dict__.setdefault("_tallyport_sources", set())
        if source not in known:
            spark.dataSource.register(source)
            known.add(source)
