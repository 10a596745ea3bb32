"""Where intermediate files go: the shared folder the cluster names."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

from callmeter.sources import folders

_ANNOUNCED: set[str] = set()


def _shared(spark: SparkSession) -> str:
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    on_one_machine = spark.sparkContext.master.partition("[")[0] == "local"
    if warehouse and (on_one_machine or urlsplit(warehouse).scheme not in ("", "file")):
        return warehouse
    raise ValueError(
        "name a folder that all executors share in spark.checkpoint.dir: files of one machine cannot be read by others"
    )


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Every executor must see the same files, so it is never a machine's own folder: where the
    cluster names none, files go below the warehouse if that is a shared store (or there is
    one machine only), else this raises. What an application wrote is removed when it ends.
    """
    mine = f"{_shared(spark).rstrip('/')}/callmeter/{spark.sparkContext.applicationId}"
    if mine not in _ANNOUNCED:
        folders.remove_at_end(spark, mine)
        _ANNOUNCED.add(mine)
    return f"{mine}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to a fresh scratch folder and read it back: what made it runs once."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
