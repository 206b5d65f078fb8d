"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "*", name: str = "tidemark") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can reach.

    Without that setting a session of one process, whose tasks see its folders, has one of its own;
    a cluster must name one.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root is None:
        if not re.fullmatch(r"local(\[[^\[]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{tempfile.gettempdir()}/tidemark-{spark.sparkContext.applicationId}"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def tidied(spark: SparkSession):
    """What runs inside leaves no shuffle files behind; otherwise they stay until the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: computed once, whatever is lost later."""
    path = shared_dir(df.sparkSession, label)
    with tidied(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
