"""Small tables that live from run to run, in versions.

A version is a folder of data and, written after it, a small file that names the folder.
Readers see a version only once that file exists.  A writer states which version its rows are
based on, and the file of the next one is put in place by a rename that fails if it is already
there: of two writers that read the same version one is refused and has to read again.  The
file system must offer such a rename (HDFS and local ones do).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Somebody else wrote the version that was to be written."""


class Files:
    """The few calls on a Hadoop file system that commits need."""

    def __init__(self, spark: SparkSession, root: str):
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.configuration = spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.system = self.path(root).getFileSystem(self.configuration)

    def path(self, name: str):
        return self.hadoop.Path(name)

    def names(self, folder: str) -> list[str]:
        path = self.path(folder)
        if not self.system.exists(path):
            return []
        return [entry.getPath().getName() for entry in self.system.listStatus(path)]

    def text(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            size = self.system.getFileStatus(self.path(name)).getLen()
            return bytes(stream.readNBytes(size)).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write a whole file under a name that must be free; nobody sees a part of it."""
        target = self.path(name)
        draft = self.hadoop.Path(target.getParent(), f"_{target.getName()}-{uuid.uuid4().hex}")
        self.system.mkdirs(target.getParent())
        stream = self.system.create(draft, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        context = self.hadoop.FileContext.getFileContext(target.toUri(), self.configuration)
        options = self.gateway.new_array(self.gateway.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(
                self.system.makeQualified(draft), self.system.makeQualified(target), options
            )
        except Exception as refused:
            self.system.delete(draft, False)
            if self.system.exists(target):
                raise Conflict(f"{name} exists already") from refused
            raise

    def remove(self, name: str) -> None:
        self.system.delete(self.path(name), True)


class VersionedTable:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.files = Files(spark, folder)

    def current(self) -> int:
        """The number of the latest version, 0 before the first."""
        names = self.files.names(f"{self.folder}/versions")
        return max((int(name) for name in names if name.isdigit()), default=0)

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version (the latest if none is named); None where there is none."""
        number = self.current() if version is None else version
        if number == 0:
            return None
        held = self.files.text(f"{self.folder}/versions/{number}")
        return self.spark.read.parquet(f"{self.folder}/data/{held}")

    def write(self, frame: DataFrame, based_on: int) -> int:
        """Store the next version; ``Conflict`` if ``based_on`` is not the latest any more."""
        if self.current() != based_on:
            raise Conflict(f"version {self.current()} was written after version {based_on} was read")
        held = uuid.uuid4().hex
        frame.write.parquet(f"{self.folder}/data/{held}")
        try:
            self.files.put(f"{self.folder}/versions/{based_on + 1}", held)
        except Conflict:
            self.files.remove(f"{self.folder}/data/{held}")
            raise
        return based_on + 1
