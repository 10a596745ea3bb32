"""Folders of any store Spark can write to: listing, renaming, removing, and replacing in one step."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """A path and the store it lies in."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder; nothing if there is none."""
    store, there = _at(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(there)) if store.exists(there) else []


def files(spark: SparkSession, path: str) -> dict[str, tuple[int, int]]:
    """Length and time of every data file below a path, by full name; hidden files are left out."""
    store, there = _at(spark, path)
    found, todo = {}, [s for s in (store.globStatus(there) or [])]
    while todo:
        status = todo.pop()
        name = status.getPath().getName()
        if name.startswith(("_", ".")) and not status.getPath().equals(there):
            continue
        if status.isDirectory():
            todo += store.listStatus(status.getPath())
        else:
            found[status.getPath().toString()] = (status.getLen(), status.getModificationTime())
    return found


def remove(spark: SparkSession, path: str) -> None:
    store, there = _at(spark, path)
    store.delete(there, True)


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Remove a folder when the driver's JVM ends."""
    store, there = _at(spark, path)
    store.mkdirs(there)
    store.deleteOnExit(there)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    store, there = _at(spark, path)
    out = store.create(there, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    store, there = _at(spark, path)
    read = store.open(there)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(read)).decode()
    finally:
        read.close()


class Publication:
    """A folder of named parts that changes as a whole.

    A new state is written to fresh folders first. Then a small file that names them, the
    pointer, is moved into place under the next number: that one rename is the change. Only
    then do folders go that the new pointer does not name. Whenever a writer is lost, readers
    find the last state that was complete; what the lost writer left is removed by the next one.
    """

    _POINTER = re.compile(r"pointer-(\d{9})\.json")

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _latest(self) -> tuple[int, dict[str, str]]:
        numbers = [int(m[1]) for n in names(self.spark, self.root) if (m := self._POINTER.fullmatch(n))]
        if not numbers:
            return 0, {}
        return max(numbers), json.loads(read_text(self.spark, f"{self.root}/pointer-{max(numbers):09d}.json"))

    def current(self) -> dict[str, str]:
        """Path of each part of the last complete state; empty if there is none yet."""
        return {part: f"{self.root}/{folder}" for part, folder in self._latest()[1].items()}

    def publish(self, writers: Mapping[str, Callable[[str], object] | None]) -> dict[str, str]:
        """Write a new state; a part without a writer stays as it is, a part not named goes."""
        number, before = self._latest()
        after = {}
        for part, write in writers.items():
            if write is None:
                after[part] = before[part]
                continue
            after[part] = f"{part}-{uuid.uuid4().hex}"
            write(f"{self.root}/{after[part]}")
        draft, name = f".draft-{uuid.uuid4().hex}", f"pointer-{number + 1:09d}.json"
        write_text(self.spark, f"{self.root}/{draft}", json.dumps(after))
        store, there = _at(self.spark, f"{self.root}/{draft}")
        if not store.rename(there, _at(self.spark, f"{self.root}/{name}")[1]):
            raise RuntimeError(f"{self.root}: another writer published state {number + 1}")
        for other in names(self.spark, self.root):
            if other != name and other not in after.values():
                remove(self.spark, f"{self.root}/{other}")
        return {part: f"{self.root}/{folder}" for part, folder in after.items()}
