"""Small-file access on the cluster's file system, and the shared scratch folder.

Only metadata passes through here (manifests, offset logs, directory listings);
table data is read and written by Spark jobs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow.fs as pafs
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


# The local property in which an incremental reader names itself to the sink it calls.
READER_PROPERTY = "sluiceworks.reader"


class SharedFiles:
    """The Hadoop file system behind whatever scheme a path names."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        hadoop_path = self._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self._conf), hadoop_path

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def read_text(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish_text(self, path: str, text: str) -> None:
        """Write beside the target, then rename, so a reader never sees half a file.

        Raises FileExistsError where the target is there, also if it came meanwhile.
        """
        fs, p = self._at(path)
        hadoop = self._jvm.org.apache.hadoop.fs
        draft = hadoop.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        where = hadoop.FileContext.getFileContext(fs.getUri(), self._conf)
        no_options = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0
        )
        try:
            # unlike FileSystem.rename it never replaces the target
            where.rename(fs.makeQualified(draft), fs.makeQualified(p), no_options)
        except Py4JJavaError as error:
            fs.delete(draft, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                raise FileExistsError(path) from None
            raise

    def below(self, path: str) -> list[tuple[str, int]]:
        """(path relative to ``path``, bytes) of all files at any depth."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        top = len(fs.makeQualified(p).toString()) + 1
        found, files = [], fs.listFiles(p, True)
        while files.hasNext():
            status = files.next()
            found.append((status.getPath().toString()[top:], status.getLen()))
        return found

    def children(self, path: str, pattern: str = "*") -> list[tuple[str, int]]:
        """(name, modification time in ms) of the visible entries, by name."""
        fs, p = self._at(f"{path}/{pattern}")
        found = fs.globStatus(p) or []
        entries = [(s.getPath().getName(), s.getModificationTime()) for s in found]
        return sorted(e for e in entries if not e[0].startswith((".", "_")))

    def size(self, path: str, pattern: str = "part-*") -> tuple[int, int]:
        """(files, bytes) of the data files directly in a directory."""
        fs, p = self._at(f"{path}/{pattern}")
        found = fs.globStatus(p) or []
        return len(found), sum(s.getLen() for s in found)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and its name there, for code in tasks and Python sources."""
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), os.path.abspath(path.removeprefix("file:"))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path in the folder all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session that
    leaves the setting empty gets a folder on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="sluiceworks-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
