"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

_made: dict[int, list[str]] = {}
_tables: dict[str, str] = {}

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(name: str = "parley", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _own_folder() -> str:
    """A temporary folder of this process, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="parley-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for a written intermediate table.

    It lies under ``spark.checkpoint.dir``, which a cluster points at shared storage; what is written
    there stays until the cluster's own clean-up or ``clear_scratch``. Only a session whose executors
    are threads of this process (``local[...]``), as in tests, may do without that setting: it gets a
    temporary folder that goes when the process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _own_folder()
    folder = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(id(spark), []).append(folder)
    return folder


def scratch_table(folder: str, name: str) -> None:
    """Notes that the catalog table ``name`` lies in a scratch folder, so that it goes with it."""
    _tables[folder] = name


def scratch_folders(spark: SparkSession) -> list[str]:
    """The scratch folders this session has asked for and not cleared, oldest first."""
    return list(_made.get(id(spark), []))


def clear_scratch(spark: SparkSession, folders: list[str] | None = None) -> None:
    """Remove scratch folders of this session, all by default; no result may depend on them any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in scratch_folders(spark) if folders is None else folders:
        if folder in _tables:
            spark.sql(f"DROP TABLE IF EXISTS {_tables.pop(folder)}")
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
        _made[id(spark)].remove(folder)
