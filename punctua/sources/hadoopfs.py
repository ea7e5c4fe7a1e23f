"""Minimal file-system access through Spark's Hadoop client (works for any
Hadoop-compatible store: local, HDFS, S3A, ABFS...).  Only metadata-sized
work happens here: listings, the first lines of new files, small JSON files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class FileInfo:
    path: str
    size: int
    mtime: int


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def qualify(spark: SparkSession, path: str) -> str:
    fs, p, _ = _fs(spark, path)
    return fs.makeQualified(p).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def list_files(spark: SparkSession, root: str, glob: str = "*") -> list[FileInfo]:
    """Recursive listing of data files under ``root`` whose *name* matches ``glob``
    (hidden ``_``/``.`` files and folders are skipped, as Spark's file sources do)."""
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    matches = jvm.org.apache.hadoop.fs.GlobFilter(glob)  # the filter behind Spark's pathGlobFilter
    out = []
    it = fs.listFiles(p, True)
    base = fs.makeQualified(p).toString().rstrip("/")
    while it.hasNext():
        st = it.next()
        full = st.getPath().toString()
        rel = full[len(base):].lstrip("/")
        if any(seg.startswith(("_", ".")) for seg in rel.split("/")):
            continue
        if matches.accept(st.getPath()):
            out.append(FileInfo(full, int(st.getLen()), int(st.getModificationTime())))
    return sorted(out, key=lambda f: f.path)


def head_lines(spark: SparkSession, path: str, n: int, encoding: str = "UTF-8") -> list[str]:
    """First ``n`` lines of a file as stored (without line terminators; a BOM stays)."""
    fs, p, jvm = _fs(spark, path)
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding))
        lines = []
        for _ in range(n):
            line = reader.readLine()
            if line is None:
                break
            lines.append(line)
        return lines
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        parts = []
        while True:
            line = reader.readLine()
            if line is None:
                break
            parts.append(line)
        return "\n".join(parts)
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one go (create, write, close); the caller never overwrites."""
    fs, p, _ = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def list_names(spark: SparkSession, folder: str) -> list[str]:
    fs, p, _ = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)
