"""Files by Hadoop's file systems, so any store that Spark reads works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, bytes and time of change of what lies right in a folder, by name; nothing if there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p))


def leaves(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the part files right in a folder of them."""
    fs, p = _fs(spark, path)
    if fs.isFile(p):
        return [path]
    return [f"{path}/{name}" for name, _, _ in children(spark, path) if not name.startswith(("_", "."))]


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} could not be moved to {target}")


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Move a file over another in one step, so one of them is there at any time."""
    hadoop = spark._jvm.org.apache.hadoop
    place = hadoop.fs.Path(target)
    context = hadoop.fs.FileContext.getFileContext(place.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context.rename(hadoop.fs.Path(source), place, options)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
