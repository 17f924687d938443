"""Small files and folders on whatever file system a path names, from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _on(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, empty where there is none; unfinished and hidden ones are left out."""
    system, at = _on(spark, folder)
    if not system.exists(at):
        return []
    found = (status.getPath().getName() for status in system.listStatus(at))
    return [name for name in found if name[0] not in "._"]


def read_text(spark: SparkSession, path: str) -> str:
    system, at = _on(spark, path)
    stream = system.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file; it appears under its name only when it is complete."""
    folder, _, name = path.rpartition("/")
    system, unfinished = _on(spark, f"{folder}/_{name}")
    stream = system.create(unfinished, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not system.rename(unfinished, spark._jvm.org.apache.hadoop.fs.Path(path)):
        raise OSError(f"could not write {path}")


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of this library's own making."""
    system, at = _on(spark, path)
    system.delete(at, True)


def make_folder(spark: SparkSession, path: str) -> None:
    system, at = _on(spark, path)
    system.mkdirs(at)
