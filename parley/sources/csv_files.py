"""CSV folders as they come: files with different headers, and cells that hold line breaks.

Spark binds one header to all files of a scan and, unless told to read each file in one task, ends a row at every line break.
So the files are sorted into groups first: by header line, and by whether a quoted cell goes over a
line's end. Each group is a scan of its own, and the scans are united by column name.
"""

from __future__ import annotations

import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Quotes inside a quoted cell are doubled, as most CSV writers do; Spark's default is a backslash.
CSV_OPTIONS = {"header": True, "nullValue": "", "escape": '"'}
#: Header lines that are read at a time.
READERS = 32


def _hadoop(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.hadoop, spark.sparkContext._jsc.hadoopConfiguration()


def _hidden(name: str) -> bool:
    return name.startswith((".", "_"))


def files_of(spark: SparkSession, path: str) -> list:
    """The files under a path or pattern, as Hadoop paths, without hidden and empty ones."""
    hadoop, conf = _hadoop(spark)
    place = hadoop.fs.Path(path)
    fs = place.getFileSystem(conf)
    found, folders = [], list(fs.globStatus(place) or [])
    while folders:
        status = folders.pop()
        if status.isDirectory():
            inner = fs.listStatus(status.getPath())
            folders += [s for s in inner if not _hidden(s.getPath().getName())]
        elif status.getLen():
            found.append(status.getPath())
    return sorted(found, key=lambda p: p.toString())


def _literal(file) -> str:
    """A file's name as a path that Spark does not take for a pattern."""
    return re.sub(r"([\[\]{}*?,\\])", r"\\\1", file.toString())


def _first_line(spark: SparkSession, file) -> str:
    hadoop, conf = _hadoop(spark)
    stream = file.getFileSystem(conf).open(file)
    codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
    if codec is not None:
        stream = codec.createInputStream(stream)
    java = spark.sparkContext._jvm.java.io
    reader = java.BufferedReader(java.InputStreamReader(stream, "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def _with_broken_lines(spark: SparkSession, files: list) -> set[str]:
    """The paths of files in which some line has an odd number of quotes: a quoted cell goes on in the next one.

    Lines are counted where they lie, in one pass over the text; only names come back.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    lines = spark.read.text([_literal(f) for f in files]).select("value", "_metadata.file_path")
    odd = lines.where(F.contains("value", F.lit('"')) & (quotes % 2 == 1))
    # names come back encoded
    return {unquote(urlsplit(r[0]).path) for r in odd.select("file_path").distinct().collect()}


def scan(spark: SparkSession, path: str, multi_line: bool | None) -> DataFrame | None:
    """All cells as text, or None if there is no file with a header. See ``readers.read_csv``."""
    files = files_of(spark, path)
    if not files:
        return None
    with ThreadPoolExecutor(READERS) as pool:
        headers = list(pool.map(partial(_first_line, spark), files))
    broken = _with_broken_lines(spark, files) if multi_line is None else set()
    groups = defaultdict(list)
    for file, header in zip(files, headers):
        over_lines = multi_line or file.toUri().getPath() in broken
        groups[header, over_lines].append(_literal(file))
    together = len(groups) == 1  # then Spark may list the folder itself
    scans = []
    for (_, over_lines), names in groups.items():
        reader = spark.read.options(**CSV_OPTIONS, enforceSchema=False, multiLine=over_lines)
        scans.append(reader.csv(path if together else names))
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), scans)
