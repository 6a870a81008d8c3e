"""Folders and small files of the cluster's storage, through Spark's own file
systems.

Paths may be on any store that Spark reads; nothing here touches the driver's
disk.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def _matching(spark: SparkSession, pattern: str, folders: bool) -> list[str]:
    fs, p = _open(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(p) or []) if s.isDirectory() == folders)


def matching_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a glob pattern."""
    return _matching(spark, pattern, True)


def matching_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files that match a glob pattern."""
    return _matching(spark, pattern, False)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, p = _open(spark, path)
    return int(fs.getContentSummary(p).getLength())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder or a file, if it is there."""
    fs, p = _open(spark, path)
    fs.delete(p, True)


def folder_number(path: str, key: str) -> int:
    """n of a path that ends in ``<key>=<n>``, or -1."""
    m = re.search(rf"(?:^|/){re.escape(key)}=(\d+)$", path)
    return int(m[1]) if m else -1


def newest_number(spark: SparkSession, path: str, key: str) -> int | None:
    """Largest n of the folders ``<path>/<key>=<n>``, finished or not; None
    without any."""
    numbers = [folder_number(f, key) for f in matching_folders(spark, f"{path}/{key}=*")]
    return max((n for n in numbers if n >= 0), default=None)


def put_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there as a whole or not at all: under
    another name first, then renamed. An existing file is an error."""
    fs, p = _open(spark, path)
    _, own = _open(spark, f"{path.rsplit('/', 1)[0]}/_tmp-{uuid.uuid4().hex}")
    out = fs.create(own, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(own, p):
        fs.delete(own, False)
        raise FileExistsError(path)


def read_file(spark: SparkSession, path: str) -> str:
    """Text of a small file."""
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


# -- marks: "all outputs up to number n are written" -----------------------------


def put_mark(spark: SparkSession, root: str, key: str, n: int) -> None:
    """Say that everything up to ``n`` is written below ``root``.

    The mark is an empty file; it is written last, and marks before it are
    removed, so there are never more than a few of them."""
    fs, p = _open(spark, f"{root.rstrip('/')}/_finished/{key}={int(n)}")
    fs.create(p, True).close()
    for f in matching_files(spark, f"{root.rstrip('/')}/_finished/{key}=*"):
        if folder_number(f, key) < n:
            remove_folder(spark, f)


def take_back_marks(spark: SparkSession, root: str, key: str, n: int) -> None:
    """Before number ``n`` is written, maybe again: readers see up to n - 1."""
    root = root.rstrip("/")
    later = [f for f in matching_files(spark, f"{root}/_finished/{key}=*") if folder_number(f, key) >= n]
    if later or not is_folder(spark, f"{root}/_finished"):
        fs, p = _open(spark, f"{root}/_finished/{key}={int(n) - 1}" if n > 0 else f"{root}/_finished/none")
        fs.create(p, True).close()
        for f in later:
            remove_folder(spark, f)


def newest_mark(spark: SparkSession, root: str, key: str) -> int | None:
    """The number up to which all is written: -1 if nothing is finished yet,
    None if the writer of ``root`` sets no marks."""
    root = root.rstrip("/")
    if not is_folder(spark, f"{root}/_finished"):
        return None
    return max((folder_number(f, key) for f in matching_files(spark, f"{root}/_finished/{key}=*")), default=-1)
