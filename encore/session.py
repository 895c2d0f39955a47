"""Session helpers: one place for the knobs every job relies on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants, whatever the cluster size.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "encore", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Order: a folder already set on the context, then ``spark.checkpoint.dir``
    from the session.  Only a ``local`` master may go without: then one is
    made for the run.  On a cluster a missing setting is an error, because a
    folder made on the driver is invisible to the executors.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               "executors share")
        d = tempfile.mkdtemp(prefix="encore-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return sc._jsc.sc().getCheckpointDir().get()


_scratch: dict[str, list[str]] = {}      # application id -> folders made and not yet released


def _hadoop(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder, dropped by
    ``release`` or else when the application ends (the file system's own
    delete-on-exit list)."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    fs, where = _hadoop(spark, path)
    fs.deleteOnExit(where)
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_paths(spark: SparkSession) -> list[str]:
    """The scratch folders of this application that are not released yet."""
    return list(_scratch.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, paths: list[str], reader: DataFrame | None = None) -> None:
    """Drop scratch folders whose readers are done (their results are written).
    Folders that ``reader`` still reads stay.  Only folders made by
    ``scratch_path`` in this application are ever dropped."""
    held = _scratch.get(spark.sparkContext.applicationId, [])
    used = reader.inputFiles() if reader is not None else []
    for path in [p for p in paths if p in held]:
        name = path.rsplit("/", 1)[1]
        if any(f"/{name}/" in f for f in used):
            continue
        fs, where = _hadoop(spark, path)
        fs.delete(where, True)
        held.remove(path)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back.

    Used for intermediates that several branches of a plan read: computed
    once, columns pruned on each later read, and a lost executor resumes from
    the files instead of replaying the lineage.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
