"""Files that are written once: commit logs on the driver, plain files on the executors.

``CommitLog`` goes through Hadoop's file systems, as Spark's own writers do.
``opened`` is for Python code that runs inside tasks and data source workers,
which have no JVM at hand.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class CommitLog:
    """Numbered JSON records below one folder, each written whole and once.

    A record is written under a name of its own and renamed without overwrite,
    so of two writers of one number the second one fails, and a reader never
    sees half a record.
    """

    def __init__(self, spark: SparkSession, folder: str):
        jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._hadoop = jvm.org.apache.hadoop
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._folder = self._hadoop.fs.Path(folder)
        self._fs = self._folder.getFileSystem(self._conf)

    def numbers(self) -> list[int]:
        if not self._fs.exists(self._folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._folder)]
        return sorted(int(n[: -len(".json")]) for n in names if n.endswith(".json") and not n.startswith("."))

    def latest(self) -> int:
        """The highest number, -1 if there is none."""
        return max(self.numbers(), default=-1)

    def exists(self, number: int) -> bool:
        return self._fs.exists(self._path(number))

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._path(number))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()

    def write(self, number: int, record: dict) -> None:
        """Raises ``FileExistsError`` if the number is taken."""
        self._fs.mkdirs(self._folder)
        draft = self._hadoop.fs.Path(self._folder, f".{number}.{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps(record).encode("utf-8")))
        stream.close()
        files = self._hadoop.fs.FileContext.getFileContext(self._folder.toUri(), self._conf)
        rename = self._hadoop.fs.Options.Rename
        target = files.makeQualified(self._path(number))
        try:
            files.rename(files.makeQualified(draft), target, self._gateway.new_array(rename, 0))
        except Exception as error:
            self._fs.delete(draft, False)
            if self.exists(number):
                raise FileExistsError(f"{target.toString()} is committed already") from error
            raise

    def _path(self, number: int):
        return self._hadoop.fs.Path(self._folder, f"{number}.json")


def data_files(spark: SparkSession, folder: str) -> list[dict]:
    """``name, bytes`` of the data files directly in a folder (metadata only)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(s.getPath().getName(), s.getLen()) for s in fs.listStatus(path) if s.isFile()]
    return [{"name": n, "bytes": size} for n, size in sorted(found) if not n.startswith(("_", "."))]


def exists(spark: SparkSession, path: str) -> bool:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of this library."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def opened(uri: str):
    """(pyarrow file system, path) of a shared folder's URI or absolute path."""
    from pyarrow import fs

    scheme, sep, rest = uri.partition(":")
    if not sep or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if sep else uri).lstrip("/")
    return fs.FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else uri)


def record_numbers(store, folder: str) -> list[int]:
    """Numbers of a commit log seen from a task (see ``CommitLog``)."""
    from pyarrow import fs

    names = [f.base_name for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True))]
    return sorted(int(n[: -len(".json")]) for n in names if n.endswith(".json") and not n.startswith("."))


def read_record(store, folder: str, number: int) -> dict:
    with store.open_input_stream(f"{folder}/{number}.json") as source:
        return json.loads(source.read().decode("utf-8"))
