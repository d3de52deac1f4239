"""The cluster's file system, through Hadoop: for folders that no table or reader owns."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    """A folder with all in it, if it is there."""
    system, at = _system(spark, path)
    system.delete(at, True)


def remove_file(spark: SparkSession, uri: str) -> None:
    """A file by its address as rows' metadata has it, with special characters escaped."""
    at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, False)


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _system(spark, path)
    return system.exists(at)


def rename(spark: SparkSession, path: str, to: str) -> None:
    system, at = _system(spark, path)
    if not system.rename(at, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"can't rename {path} to {to}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it isn't there."""
    system, at = _system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(at)) if system.exists(at) else []


def make(spark: SparkSession, path: str) -> None:
    """A folder, with those above it."""
    system, at = _system(spark, path)
    system.mkdirs(at)


def rename_into(spark: SparkSession, path: str, to: str) -> None:
    """A file to its place, unless a move cut short has brought it there."""
    system, at = _system(spark, path)
    place = spark._jvm.org.apache.hadoop.fs.Path(to)
    try:
        if system.rename(at, place):
            return
    except Exception:  # some file systems raise where others say no
        pass
    if not system.exists(at):
        if system.exists(place):
            return
        raise OSError(f"neither {path} nor {to} is there")
    system.delete(place, False)
    rename(spark, path, to)


def files(spark: SparkSession, path: str) -> list[str]:
    """All files below a folder, by their paths within it; one listing."""
    system, at = _system(spark, path)
    base, found = system.makeQualified(at).toString().rstrip("/") + "/", []
    listing = system.listFiles(at, True)
    while listing.hasNext():
        found.append(listing.next().getPath().toString().removeprefix(base))
    return sorted(found)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file, whose name says what has been done."""
    system, at = _system(spark, path)
    system.create(at, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is either there whole or not at all."""
    system, at = _system(spark, f"{path}.part")
    out = system.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename(spark, f"{path}.part", path)


def read_text(spark: SparkSession, path: str) -> str:
    system, at = _system(spark, path)
    source = system.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
