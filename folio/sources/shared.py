"""Folders that the driver and all executors see, and what the stores need of Hadoop's file systems."""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Folders of applications that run on this machine only and name none, by application id.
OWN_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where none is set, a temporary one if Spark has this machine only; a cluster has to name one, as no other folder is known to be shared."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        found = OWN_FOLDERS.get(app) or OWN_FOLDERS.setdefault(app, tempfile.mkdtemp(prefix="folio-"))
    return found.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


class Files:
    """The few operations that a store needs, on any file system that Spark can open."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf, self.gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        """The names in a folder, sorted; none if there is no such folder."""
        path = self.path(folder)
        fs = path.getFileSystem(self.conf)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def delete(self, name: str) -> None:
        path = self.path(name)
        path.getFileSystem(self.conf).delete(path, True)

    def make(self, folder: str) -> None:
        path = self.path(folder)
        path.getFileSystem(self.conf).mkdirs(path)

    def touch(self, name: str) -> None:
        path = self.path(name)
        path.getFileSystem(self.conf).create(path, True).close()

    def moved(self, source: str, target: str) -> bool:
        """Rename a folder unless the target is there already: false if it is. HDFS does this in one step, whoever comes second."""
        to = self.path(target)
        to.getFileSystem(self.conf).mkdirs(to.getParent())
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), self.conf)
        plain = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self.path(source), to, plain)
        except Py4JJavaError as failed:
            if failed.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True
