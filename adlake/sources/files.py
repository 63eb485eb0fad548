"""Files of a shared store, through the file system that Spark itself uses for their path."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """The files of one path, whatever store it is in."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.path = path.rstrip("/")
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return sorted(status.getPath().getName() for status in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def text(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """A whole file at once: written under another name, then renamed."""
        if self.fs.exists(self._at(name)):
            raise FileExistsError(f"{self.path}/{name}")
        folder, _, last = name.rpartition("/")
        aside = f"{folder}/.{last}-{uuid.uuid4().hex}"
        stream = self.fs.create(self._at(aside), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.rename(self._at(aside), self._at(name)):
            raise FileExistsError(f"{self.path}/{name}")

    def size(self, name: str) -> int:
        """Bytes of all files under a name."""
        return self.fs.getContentSummary(self._at(name)).getLength()

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


def _of_scan(spark: SparkSession, file: str):
    """A file by the name that scans give it, in which odd characters are encoded."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))


def replace_file(spark: SparkSession, old: str, new: str) -> None:
    """Put the file ``new`` in the place of ``old`` (as a scan names it) by one rename: readers
    see either, whole."""
    hadoop, target = spark._jvm.org.apache.hadoop.fs, _of_scan(spark, old)
    choice = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(choice, 1)
    options[0] = choice.OVERWRITE
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(hadoop.Path(new), target, options)


def delete_file(spark: SparkSession, file: str) -> None:
    """Delete a file, as a scan names it."""
    target = _of_scan(spark, file)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, False)
