"""Files and folders of a table exchanged as one step that a stopped job can finish.

New files are written to a folder beside those they replace, under a name that
Spark's scans do not see, and their footers are read. Then a journal with all the renames is put
there under its final name: from that moment on the exchange happens, before it
nothing has. Whoever finds a journal goes on with the renames that are left, so
a table is never half of one thing and half of another. A folder without a
journal is what a failed write left behind, or the remains of a finished
exchange, and goes with the next write.

A table has one writer at a time, as before. Renames are as cheap as the file
system makes them: one operation each on HDFS, a copy on an object store.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

PREFIX = "_swap-"
JOURNAL = "journal"
ID = 32  # characters of an exchange's id
CODEC = "zstd"  # of the files that are written


class Files:
    """The file operations of a path's file system."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self.fs: JavaObject = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(e.getPath().getName() for e in self.fs.listStatus(self._path(path)))

    def make(self, path: str) -> None:
        self.fs.mkdirs(self._path(path))

    def move(self, source: str, target: str) -> None:
        """Rename, unless another one did; the target does not exist, its folder does."""
        if not self.fs.rename(self._path(source), self._path(target)) and self.exists(source):
            raise OSError(f"{source} cannot be renamed to {target}")

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def write(self, path: str, text: str) -> None:
        out = self.fs.create(self._path(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()


class Swap:
    """One exchange of entries of ``base``, known by ``label``."""

    def __init__(self, spark: SparkSession, base: str, label: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")
        self.files = Files(spark, self.base)
        self.folder = f"{self.base}/{PREFIX}{label}-{uuid.uuid4().hex}"

    @property
    def new(self) -> str:
        """Where new entries are written, under the names they shall have."""
        return f"{self.folder}/new"

    def commit(self, put: Iterable[str] = (), drop: Iterable[str] = ()) -> None:
        """Put these entries in place of what has their names, and drop those."""
        plan = json.dumps({"put": list(put), "drop": list(drop)})
        self.files.write(f"{self.folder}/{JOURNAL}.tmp", plan)
        self.files.move(f"{self.folder}/{JOURNAL}.tmp", f"{self.folder}/{JOURNAL}")
        finish(self.files, self.base, self.folder)


def finish(files: Files, base: str, folder: str) -> None:
    """The renames of a journal that are left; any number of attempts end alike."""
    plan = json.loads(files.read(f"{folder}/{JOURNAL}"))
    listed: dict[str, set[str]] = {}

    def there(path: str) -> bool:
        parent, _, name = path.rpartition("/")
        if parent not in listed:
            listed[parent] = set(files.names(parent))
        return name in listed[parent]

    for parent in {n.rpartition("/")[0] for n in [*plan["put"], *plan["drop"]]}:
        files.make(f"{folder}/old/{parent}")
        files.make(f"{base}/{parent}")
    for name in plan["put"]:
        if there(f"{folder}/new/{name}"):
            if there(f"{base}/{name}"):
                files.move(f"{base}/{name}", f"{folder}/old/{name}")
            files.move(f"{folder}/new/{name}", f"{base}/{name}")
    for name in plan["drop"]:
        if there(f"{base}/{name}"):
            files.move(f"{base}/{name}", f"{folder}/old/{name}")
    files.delete(f"{folder}/{JOURNAL}")
    files.delete(folder)


def _exchanges(files: Files, base: str, label: str) -> list[str]:
    start = f"{PREFIX}{label}-"
    return [f"{base}/{n}" for n in files.names(base) if n.startswith(start) and len(n) == len(start) + ID]


def settle(spark: SparkSession, path: str, clean: bool = False) -> None:
    """Finish the exchanges of a table, and of its entries, that a stopped job began.

    With ``clean``, for its writer alone, what failed writes left goes too.
    """
    base, _, name = path.rstrip("/").rpartition("/")
    files = Files(spark, base)
    for place, label in ((base, name), (path.rstrip("/"), "entries")):
        for folder in _exchanges(files, place, label):
            if files.exists(f"{folder}/{JOURNAL}"):
                finish(files, place, folder)
            elif clean:
                files.delete(folder)


def of_table(spark: SparkSession, path: str) -> tuple[Swap, str]:
    """An exchange of the whole table, and the name of its folder."""
    settle(spark, path, clean=True)
    base, _, name = path.rstrip("/").rpartition("/")
    return Swap(spark, base, name), name


def of_entries(spark: SparkSession, path: str) -> Swap:
    """An exchange of folders or files inside a table."""
    settle(spark, path, clean=True)
    return Swap(spark, path, "entries")


def check(spark: SparkSession, path: str) -> int:
    """The rows of a folder by the footers of its files; fails if one cannot be read."""
    return spark.read.schema("`-` int").parquet(path).count()


def write_checked(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Write a folder that nobody reads yet, and read the footers of all its files."""
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path, compression=CODEC)
    check(df.sparkSession, path)
