"""Session used by the jobs, the tests and the bench."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Raw times carry no zone, so they are read and written in UTC.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "gaugeworks", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; on a cluster ``master`` comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, near: str) -> str:
    """Folder for intermediate tables that outlive executors.

    The one the cluster names in ``spark.checkpoint.dir``; a session on one machine may go without, next to ``near``.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{near.rstrip('/')}_staged"


def storage(spark: SparkSession, path: str):
    """The file system that ``path`` is on, and ``path`` as its own kind of path."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's making, on whatever storage it is."""
    files, place = storage(spark, path)
    files.delete(place, True)


def join_files(spark: SparkSession, parts: list[str], target: str, first: str = "") -> None:
    """One file of the text ``first`` and the bytes of ``parts``, in order, streamed from file to file."""
    files, place = storage(spark, target)
    jvm = spark.sparkContext._jvm
    unfinished = jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_{place.getName()}")
    out = files.create(unfinished, True)
    out.write(bytearray(first.encode()))
    for part in parts:
        source, at = storage(spark, part)
        stream = source.open(at)
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
        stream.close()
    out.close()
    files.rename(unfinished, place)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none where there is no folder."""
    files, place = storage(spark, path)
    return sorted(entry.getPath().getName() for entry in files.listStatus(place)) if files.exists(place) else []


def fresh_folder(spark: SparkSession, near: str) -> str:
    """A new, not yet existing folder below the shared one."""
    return f"{shared_folder(spark, near)}/{uuid.uuid4().hex}"
