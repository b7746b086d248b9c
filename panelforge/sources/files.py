"""Single files through Spark's file systems: first lines of many, and files that are written once."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Bytes asked for at first; a longer first line takes twice as many with each further read.
FIRST_BYTES = 8192
# Files open at once.
OPEN_FILES = 16


def hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    found, fs = hadoop_path(spark, path)
    return fs.exists(found)


@dataclass(frozen=True)
class FirstLine:
    """The first line of a file that is not blank, and how many bytes were read to find it."""

    text: str
    bytes_read: int


def _line(raw: bytes, ended: bool) -> str | None:
    """The first line with a visible character, if ``raw`` holds all of it."""
    lines = raw.splitlines(keepends=True)
    for k, line in enumerate(lines):
        if line.strip():
            whole = ended or k + 1 < len(lines) or line.endswith(b"\n")
            return line.decode("utf-8", "replace").rstrip("\r\n") if whole else None
    return "" if ended else None


def _first_line(spark: SparkSession, path: str) -> FirstLine:
    found, fs = hadoop_path(spark, path)
    opened = fs.openFile(found).opt("fs.option.openfile.read.policy", "random").build().get()
    try:
        raw, want = b"", FIRST_BYTES
        while True:
            more = bytes(opened.readNBytes(want))
            raw += more
            line = _line(raw, len(more) < want)
            if line is not None:
                return FirstLine(line, len(raw))
            want = len(raw)
    finally:
        opened.close()


def first_lines(spark: SparkSession, paths: Sequence[str], open_files: int = OPEN_FILES) -> list[FirstLine]:
    """The first line of each file, in the order of ``paths``.

    A few kilobytes are read of each file, whatever its size, by a bounded pool of open streams: no
    Spark job, and nothing but the lines is kept.
    """
    if not paths:
        return []
    with ThreadPoolExecutor(min(open_files, len(paths))) as pool:
        return list(pool.map(lambda path: _first_line(spark, path), paths))


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False if another writer was first.

    The text is written under a name of its own and then moved, which fails if the name is taken. So readers
    see all of it or nothing.
    """
    jvm = spark._jvm
    target, fs = hadoop_path(spark, path)
    if fs.exists(target):
        return False
    fs.mkdirs(target.getParent())
    own, _ = hadoop_path(spark, f"{target.getParent()}/.{target.getName()}-{uuid.uuid4().hex}")
    out = fs.create(own, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(own, target, options)
        return True
    except Exception as error:
        fs.delete(own, False)
        if "FileAlreadyExists" in str(error):
            return False
        raise


def read_text(spark: SparkSession, path: str) -> str:
    found, fs = hadoop_path(spark, path)
    opened = fs.open(found)
    try:
        return bytes(opened.readAllBytes()).decode()
    finally:
        opened.close()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names directly in ``folder``, sorted; none if it does not exist."""
    found, fs = hadoop_path(spark, folder)
    if not fs.exists(found):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(found))


def delete(spark: SparkSession, path: str) -> None:
    found, fs = hadoop_path(spark, path)
    fs.delete(found, True)
