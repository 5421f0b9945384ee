"""Session helpers: local builder for tests and the shared scratch location."""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "opstide") -> SparkSession:
    """Single-machine session used by the tests and the benchmark."""
    n = os.cpu_count() if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, read only, since Spark does not let a session change it.

    Where the setting is absent, a folder below ``spark.sql.warehouse.dir`` is
    taken. A warehouse on a machine's own disk serves a local master only; on
    any other a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        own_disk = urlparse(warehouse).scheme in ("", "file") and not _shared_default(spark)
        if own_disk and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set and the warehouse is a local folder: name a folder that all executors share")
        named = warehouse.rstrip("/") + "/_scratch"
    return named.rstrip("/")


def _shared_default(spark: SparkSession) -> bool:
    """Whether paths without a scheme lie in a shared file system."""
    return urlparse(spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")).scheme not in ("", "file") and not urlparse(
        spark.conf.get("spark.sql.warehouse.dir")
    ).scheme


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: Intermediate tables written by this process and not removed yet, oldest first.
_written: list[str] = []


def materialise(df, name: str):
    """Write a DataFrame to the shared folder and read it back, cutting lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    _written.append(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.written_at = path
    return found


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    if path in _written:
        _written.remove(path)


def written() -> int:
    """Mark of the intermediate tables written so far, for ``remove_since``."""
    return len(_written)


def remove_since(spark: SparkSession, mark: int, *keep) -> None:
    """Remove the intermediate tables written after ``mark``, but for those whose DataFrames ``materialise`` gave as ``keep``.

    Only for a point where nothing but ``keep`` is read any more.
    """
    kept = {getattr(df, "written_at", None) for df in keep}
    for path in [p for p in _written[mark:] if p not in kept]:
        remove(spark, path)
