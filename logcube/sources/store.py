"""Small files on the cluster's file system, through Spark's Hadoop client.

For bookkeeping only (a few kB per log day); tables are read and written by
Spark jobs."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Older versions of a file that are left to readers that have listed them already.
KEPT_VERSIONS = 10
#: A version is committed again after another writer was first, so many times.
ATTEMPTS = 100


class Conflict(RuntimeError):
    """Other writers were first every time."""


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, where, fs = _hadoop(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in ``folder``, in order; empty if there is none."""
    _, where, fs = _hadoop(spark, folder)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where))


def get_text(spark: SparkSession, path: str) -> str:
    jvm, where, fs = _hadoop(spark, path)
    source = fs.open(where)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write ``path`` whole, but only if there is none: False if there is.  One
    of several writers wins where the file system renames in one step."""
    jvm, where, fs = _hadoop(spark, path)
    if fs.exists(where):
        return False
    part = jvm.org.apache.hadoop.fs.Path(where.getParent(), f"_{where.getName()}.{uuid.uuid4().hex}")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE  # fails if there is one
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(fs.makeQualified(part), fs.makeQualified(where), how)
    except Py4JJavaError as e:
        fs.delete(part, False)
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise
    return True


_VERSION = re.compile(r"(.+)\.(\d{10})\.json")


def versions(spark: SparkSession, folder: str) -> dict[str, int]:
    """The last version of every versioned file of ``folder`` by its name."""
    found: dict[str, int] = {}
    for m in filter(None, map(_VERSION.fullmatch, names(spark, folder))):
        found[m[1]] = max(found.get(m[1], 0), int(m[2]))
    return found


def version_path(folder: str, name: str, version: int) -> str:
    return f"{folder.rstrip('/')}/{name}.{version:010d}.json"


def current(spark: SparkSession, folder: str, name: str, version: int | None = None) -> tuple[int, dict | None]:
    """Last version of ``name`` and its content; 0 and None if there is none."""
    version = versions(spark, folder).get(name, 0) if version is None else version
    return version, json.loads(get_text(spark, version_path(folder, name, version))) if version else None


def update(spark: SparkSession, folder: str, name: str, change: Callable[[dict | None], dict | None]) -> dict | None:
    """Commit ``change`` of the present content of ``name`` as its next version.

    Several writers may do so: who finds that version taken changes what the
    other has committed, so none is lost.  ``change`` gives None to commit nothing."""
    for _ in range(ATTEMPTS):
        version, content = current(spark, folder, name)
        new = change(content)
        if new is None:
            return None
        if put_new(spark, version_path(folder, name, version + 1), json.dumps(new)):
            if version - KEPT_VERSIONS > 0:
                delete(spark, version_path(folder, name, version - KEPT_VERSIONS))
            return new
    raise Conflict(f"{folder}/{name}")


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write ``path`` whole: readers see the old text or the new one."""
    jvm, where, fs = _hadoop(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(where.getParent(), f"_{where.getName()}.{uuid.uuid4().hex}")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(fs.makeQualified(part), fs.makeQualified(where), how)


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a folder that its owner replaces; False if there is none."""
    _, where, fs = _hadoop(spark, path)
    return fs.delete(where, True)
