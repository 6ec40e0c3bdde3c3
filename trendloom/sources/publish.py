"""Publishing: a table is written beside its target and renamed to it when whole.

Readers of the target see the table before or the one after, never a part of
one; a failed job leaves the target as it was. Staging folders begin with an
underscore, which Spark's readers pass over.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

MARK = "_SUCCESS"
#: A file that some task of Spark's writers wrote.
_PART = re.compile(r"part-\d{5}-[0-9a-f-]{36}")


def _file_system(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def staging_path(target: str) -> str:
    folder, _, name = target.rstrip("/").rpartition("/")
    return f"{folder}/_staging-{name}-{uuid.uuid4().hex}"


def is_there(spark: SparkSession, path: str) -> bool:
    at, fs = _file_system(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at, fs = _file_system(spark, path)
    fs.delete(at, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """``source`` takes the place of ``target``, which goes only once that is done."""
    frm, fs = _file_system(spark, source)
    to, _ = _file_system(spark, target.rstrip("/"))
    old = _file_system(spark, staging_path(target))[0] if fs.exists(to) else None
    if to.getParent() is not None:
        fs.mkdirs(to.getParent())
    if old is not None and not fs.rename(to, old):
        raise OSError(f"could not set {target} aside")
    if not fs.rename(frm, to):
        if old is not None:
            fs.rename(old, to)
        raise OSError(f"could not publish {source} as {target}")
    if old is not None:
        fs.delete(old, True)


def published(spark: SparkSession, target: str, write: Callable[[str], object]) -> str:
    """``write`` to a staging folder, then publish it as ``target``; the folder goes if writing fails."""
    staged = staging_path(target)
    try:
        write(staged)
    except BaseException:
        remove(spark, staged)
        raise
    move(spark, staged, target)
    return target


def finished(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is whole: a file, a folder with the mark of success, or one that Spark's writers didn't write."""
    at, fs = _file_system(spark, path)
    if not fs.exists(at) or not fs.getFileStatus(at).isDirectory():
        return True
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return MARK in names or not any(_PART.match(n) or n == "_temporary" for n in names)
