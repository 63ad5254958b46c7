"""Path checks through the Hadoop FileSystem API.

Works for every filesystem the cluster can read (HDFS, S3A, ABFS, local),
unlike ``os.path``, which only sees the driver's disk.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.exists(hpath))


def require_path(spark: SparkSession, path: str, what: str = "input") -> str:
    """Typed guard: ``FileNotFoundError`` if ``path`` does not exist."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"{what} not found: {path}")
    return path


def data_files(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Data files (not ``_SUCCESS``/hidden files) directly under ``path``."""
    fs, hpath = _fs_and_path(spark, path)
    out = []
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        if st.isFile() and name.endswith(suffix) and not name.startswith(("_", ".")):
            out.append(st.getPath().toString())
    return sorted(out)


def file_fingerprint(spark: SparkSession, path: str) -> tuple[int, int]:
    """(total bytes, newest modification time) of a file or folder tree."""
    fs, hpath = _fs_and_path(spark, path)
    summary = fs.getContentSummary(hpath)
    newest = 0
    it = fs.listFiles(hpath, True)
    while it.hasNext():
        newest = max(newest, it.next().getModificationTime())
    return int(summary.getLength()), int(newest)


def replace_path(spark: SparkSession, src: str, dst: str) -> str:
    """Rename a file or folder on its filesystem (metadata-only on HDFS); what
    an earlier run left at ``dst`` is replaced."""
    fs, hsrc = _fs_and_path(spark, src)
    _, hdst = _fs_and_path(spark, dst)
    if fs.exists(hdst):
        fs.delete(hdst, True)
    if not fs.rename(hsrc, hdst):
        raise OSError(f"could not rename {src} to {dst}")
    return dst


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder tree, if it is there."""
    fs, hpath = _fs_and_path(spark, path)
    fs.delete(hpath, True)


def ensure_folder(spark: SparkSession, path: str) -> str:
    """Make the folder ``path``, if it is not there."""
    fs, hpath = _fs_and_path(spark, path)
    fs.mkdirs(hpath)
    return path
