"""Session settings and the shared scratch folder."""

from __future__ import annotations

import importlib
import io
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from watchfold.sources.files import open_filesystem


def session(app: str = "watchfold", **settings: str) -> SparkSession:
    """A session with adaptive execution and UTC; cluster settings win where given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # a busy flow's packets merge within each task before the shuffle
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        # plans of many columns build several times faster without call sites
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_root: str | None = None


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Without that setting a local master, all of whose tasks share one disk, gets a
    temporary folder; a cluster must name one.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="watchfold-")
        spark.sparkContext.setCheckpointDir(_local_root)
    return _local_root


_removed_at_end: set[str] = set()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """Name of a new folder below the shared checkpoint folder.

    It lies in a folder of the application, which goes when the driver ends.
    """
    base = f"{checkpoint_root(spark)}/{spark.sparkContext.applicationId}"
    if base not in _removed_at_end:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(base)
        filesystem = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        filesystem.mkdirs(path)
        filesystem.deleteOnExit(path)
        _removed_at_end.add(base)
    return f"{base}/{name}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship(spark: SparkSession, *packages: str) -> None:
    """Sends source packages to the Python workers, once per application.

    The archive lies in the shared checkpoint folder. A job submitted with
    ``--py-files`` does not need this.
    """
    application = spark.sparkContext.applicationId
    names = [p for p in packages if f"{application}/{p}" not in _shipped]
    if not names:
        return
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as target:
        for name in names:
            root = Path(importlib.import_module(name).__file__).parent
            for file in sorted(root.rglob("*.py")):
                target.write(file, file.relative_to(root.parent))
            _shipped.add(f"{application}/{name}")
    path = f"{scratch_dir(spark, '-'.join(names))}.zip"
    filesystem, place = open_filesystem(path)
    filesystem.create_dir(place.rsplit("/", 1)[0])
    with filesystem.open_output_stream(place) as out:
        out.write(archive.getvalue())
    spark.sparkContext.addPyFile(path)
