"""One writer at a time: a lease by name in a shared folder, whose latest holder fences those before it."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


class Fenced(RuntimeError):
    """Another job has taken the lease since."""


class Lease:
    """Epochs of a name: files ``<folder>/<name>/<epoch>``, each created by one holder only.

    Whoever takes the lease gets the next epoch; a holder that finds a later one has been
    fenced, and must not write. A job checks before each batch and again before its commit. What
    a fenced job has put out in between is a folder under its own name and batch, which no reader
    sees before it is committed.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str):
        if not name or "/" in name:
            raise ValueError("a lease needs a name without slashes")
        self.spark, self.folder, self.name = spark, f"{folder.rstrip('/')}/{name}", name
        self.epoch = -1

    def _path(self, epoch: int):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{epoch:012d}")

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, epoch: int) -> bool:
        path = self._path(epoch)
        return self._fs(path).exists(path)

    def _create(self, epoch: int) -> bool:
        """Whether the file is new: of several that try, one succeeds."""
        path = self._path(epoch)
        fs = self._fs(path)
        fs.mkdirs(path.getParent())
        if fs.getUri().getScheme() == "file":
            try:
                os.close(os.open(path.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
                return True
            except FileExistsError:
                return False
        return fs.createNewFile(path)

    def take(self) -> Lease:
        epoch = max(self.epoch + 1, 0)
        step = 1
        while self._exists(epoch + step - 1):  # epochs have no holes
            epoch, step = epoch + step, step * 2
        while step > 1:
            step //= 2
            if self._exists(epoch + step - 1):
                epoch += step
        while not self._create(epoch):
            epoch += 1
        self.epoch = epoch
        return self

    def check(self) -> None:
        if self.epoch < 0 or self._exists(self.epoch + 1):
            raise Fenced(f"the lease on {self.name} is held by a later job than that of epoch {self.epoch}")
