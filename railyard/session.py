"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_WORK: dict[str, tempfile.TemporaryDirectory] = {}


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass your own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("railyard")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` decides where. A local master, whose executors share this
    machine's disk, may do without; on a cluster a missing setting is an error, as every
    executor would write to a disk of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if "root" not in _LOCAL_WORK:
            _LOCAL_WORK["root"] = tempfile.TemporaryDirectory(prefix="railyard-")
        root = _LOCAL_WORK["root"].name
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop client."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a work folder that is no longer read."""
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on whatever file system its scheme names."""
    fs, hadoop_path = _file_system(spark, path)
    return bool(fs.exists(hadoop_path))


def same_store(spark: SparkSession, a: str, b: str) -> bool:
    """Whether two paths lie in one file system, so that a folder can be moved."""
    return _file_system(spark, a)[0].getUri().equals(_file_system(spark, b)[0].getUri())


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all: written aside, then renamed."""
    fs, hadoop_path = _file_system(spark, path)
    aside = hadoop_path.suffix(".new")
    out = fs.create(aside, True)
    out.writeBytes(text)
    out.close()
    fs.rename(aside, hadoop_path)


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of a note, or None where there is none."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return None
    source = fs.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def leaf_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """The partition folders ``depth`` levels below ``path``, as relative paths."""
    fs, hadoop_path = _file_system(spark, path)
    found = [""]
    for _ in range(depth):
        below = []
        for folder in found:
            here = hadoop_path if not folder else spark.sparkContext._jvm.org.apache.hadoop.fs.Path(hadoop_path, folder)
            for status in fs.listStatus(here):
                name = status.getPath().getName()
                if status.isDirectory() and not name.startswith(("_", ".")):
                    below.append(f"{folder}/{name}".lstrip("/"))
        found = below
    return found


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to where another one may stand. A move cut short can be repeated."""
    fs, old = _file_system(spark, target)
    fs.delete(old, True)
    fs.mkdirs(old.getParent())
    if not fs.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source), old):
        raise OSError(f"{source} could not be moved to {target}")
