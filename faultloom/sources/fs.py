"""Paths on whatever file system the cluster uses, through Hadoop's own API."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def subdirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly under a path, sorted."""
    if not exists(spark, path):
        return []
    found = _fs(spark, path).listStatus(_path(spark, path))
    return sorted(s.getPath().getName() for s in found if s.isDirectory())


def find(spark: SparkSession, root: str, name: str) -> list[str]:
    """Every path called ``name`` under a root, however deep, sorted.

    A descent of directories; what is found is not entered. It grows with shards.
    """
    if not exists(spark, root):
        return []
    fs, found, open_ = _fs(spark, root), [], [_path(spark, root)]
    while open_:
        for status in fs.listStatus(open_.pop()):
            path = status.getPath()
            if path.getName() == name:
                found.append(path.toString())
            elif status.isDirectory():
                open_.append(path)
    return sorted(found)


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def current_version(spark: SparkSession, path: str) -> str | None:
    """The newest complete version of a versioned table, None before the first."""
    found = [
        (int(name.split("-")[1]), name)
        for name in subdirs(spark, path)
        if name.startswith("v-") and exists(spark, f"{path}/{name}/_SUCCESS")
    ]
    return f"{path}/{max(found)[1]}" if found else None


def write_version(df: DataFrame, path: str) -> None:
    """Write a table's next version beside the last. Its success marker commits it.

    It may be computed from the version it follows. That one stays for readers
    that have begun; older ones are deleted.
    """
    spark, last = df.sparkSession, current_version(df.sparkSession, path)
    n = 1 if last is None else int(last.rsplit("/", 1)[1].split("-")[1]) + 1
    target = f"{path}/v-{n}-{uuid.uuid4().hex}"
    df.write.parquet(target)
    for name in subdirs(spark, path):
        if f"{path}/{name}" not in (last, target):
            delete(spark, f"{path}/{name}")


def readable(spark: SparkSession, target: str) -> str | None:
    """Where a table that was swapped in whole can be read: the target, or the copy of a swap that was cut short."""
    for path in (target, f"{target}.previous"):
        if exists(spark, path):
            return path
    return None


def recover(spark: SparkSession, target: str) -> None:
    """Finish or undo a swap that was cut short."""
    old = f"{target}.previous"
    if not exists(spark, old):
        return
    if exists(spark, target):
        _fs(spark, old).delete(_path(spark, old), True)
    else:
        _rename(spark, old, target)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    if not _fs(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"could not move {source} to {target}")
