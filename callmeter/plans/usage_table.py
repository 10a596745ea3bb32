"""The tables the registered queries work on.

``usage`` derives a usage table from order tables: one order plays one account. Minutes
are whole numbers and charge rates powers of two, so every sum is exact and no result
depends on row order.

The three-way join behind it runs once per application and folder. Its result, and the
cleaned, split and featured table made from it, are written as Parquet to the shared
scratch folder, and every other query starts from there.
"""

from __future__ import annotations

import hashlib
import json
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callmeter.operators.clean import base, clean_rows, zscore_status
from callmeter.operators.features import add_features
from callmeter.operators.split import random_split
from callmeter.schema import FEATURES, IDENTIFIER, KEY, LABEL, MEASURES, RECORD
from callmeter.sources import folders
from callmeter.sources.scratch import scratch_path
from callmeter.sources.usage_io import write_usage

# Charge per minute of each period.
RATES = {"day": 0.25, "eve": 0.125, "night": 0.0625, "intl": 0.5}
PERIOD_OF_PART = {0: "day", 1: "eve", 2: "night", 3: "intl"}


def usage(spark: SparkSession, sf_dir: str, *, fill: bool = True) -> DataFrame:
    """``account_id`` and the 17 record columns.

    Line items are summed by order, and all three inputs meet on the order number, so each
    is shuffled once. Without ``fill`` an order that has no line items, or no event, keeps nulls
    in the columns that come from there.
    """
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    part = F.col("l_partkey") % 4
    minutes = {
        f"{period}_mins": F.sum(F.when(part == k, F.col("l_quantity")).otherwise(0.0))
        for k, period in PERIOD_OF_PART.items()
        if period != "intl"
    }
    calls = {f"{p}_calls": F.count_if(part == k) for k, p in PERIOD_OF_PART.items()}
    returned = {
        "custserv_calls": F.count_if(F.col("l_returnflag") == "R"),
        "vmail_message": F.count_if(F.col("l_returnflag") == "A"),
    }
    lines = (
        read("lineitem")
        .groupBy(F.col("l_orderkey").alias(KEY))
        .agg(
            *[agg.alias(name) for name, agg in minutes.items()],
            *[agg.cast("int").alias(name) for name, agg in {**calls, **returned}.items()],
        )
    )
    orders = read("orders").select(
        F.col("o_orderkey").alias(KEY), "o_custkey", "o_orderstatus"
    )
    events = read("events").select(
        F.col("event_id").alias(KEY), F.floor("value").cast("double").alias("intl_mins")
    )
    joined = orders.join(lines, KEY, "left").join(events, KEY, "left")
    filled = lambda name, value: F.coalesce(F.col(name), F.lit(value)) if fill else F.col(name)
    whole = {name: filled(name, 0) for name in (*calls, *returned)}
    timed = {name: filled(name, 0.0) for name in (*minutes, "intl_mins")}
    known = lambda condition: F.coalesce(condition, F.lit(False))
    return joined.withColumns({**whole, **timed}).select(
        KEY,
        F.concat(F.lit("555-"), F.col(KEY).cast("string")).alias(IDENTIFIER),
        (F.col("o_custkey") % 243).cast("int").alias("account_length"),
        *whole,
        *timed,
        *[(F.col(f"{p}_mins") * rate).alias(f"{p}_charge") for p, rate in RATES.items()],
        (
            known(F.col("custserv_calls") >= 3)
            | known((F.col("o_orderstatus") == "F") & (F.col("day_mins") > 60.0))
        ).alias(LABEL),
    ).select(KEY, *RECORD)


#: Tables that ``usage`` reads.
SOURCES = ("orders", "lineitem", "events")

_WRITTEN: dict[tuple, str] = {}
_WRITING = threading.RLock()


def source_state(spark: SparkSession, sf_dir: str) -> str:
    """A fingerprint of the source files: their names, sizes and times."""
    found = [sorted(folders.files(spark, f"{sf_dir}/{name}.parquet").items()) for name in SOURCES]
    return hashlib.sha256(json.dumps(found).encode()).hexdigest()


def written(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    build: Callable[[], DataFrame],
    partition_by: list[str] | None = None,
) -> DataFrame:
    """The table ``name``, written on first use and read back from then on.

    A manifest lies beside the files: the state of the source they were made from, the rows
    counted while writing, and the name and length of every file. A table is used again only if
    its source is as it was and all its files are there; else it is made anew.
    """
    place, state = (spark.sparkContext.applicationId, sf_dir, name), source_state(spark, sf_dir)
    with _WRITING:
        if (path := _WRITTEN.get(place)) and (schema := _intact(spark, path, state)):
            return spark.read.schema(schema).parquet(path)
        path, table, seen = scratch_path(spark, name), build(), Observation()
        write_usage(table.observe(seen, F.count("*").alias("rows")), path, partition_by=partition_by)
        lengths = {file: size for file, (size, _) in folders.files(spark, path).items()}
        manifest = {"source": state, "rows": seen.get["rows"], "files": lengths, "schema": table.schema.jsonValue()}
        folders.write_text(spark, f"{path}/{MANIFEST}", json.dumps(manifest))
        _WRITTEN[place] = path
        return spark.read.schema(table.schema).parquet(path)


MANIFEST = "_manifest.json"


def _intact(spark: SparkSession, path: str, state: str) -> T.StructType | None:
    """The schema of a stored table whose manifest still holds, else nothing."""
    if MANIFEST not in folders.names(spark, path):
        return None
    manifest = json.loads(folders.read_text(spark, f"{path}/{MANIFEST}"))
    lengths = {file: size for file, (size, _) in folders.files(spark, path).items()}
    if manifest["source"] != state or manifest["files"] != lengths:
        return None
    return T.StructType.fromJson(manifest["schema"])


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usage table as stored: ``account_id`` and the 17 record columns."""
    return written(spark, sf_dir, "usage", lambda: usage(spark, sf_dir))


def incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage that keeps its gaps: nulls where an account has no calls or no foreign minutes."""
    build = lambda: base(usage(spark, sf_dir, fill=False), drop=[IDENTIFIER], label=LABEL)
    return written(spark, sf_dir, "usage-gaps", build)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage without the identifier, label as 0/1."""
    return base(records(spark, sf_dir), drop=[IDENTIFIER], label=LABEL)


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zscore_status(labelled(spark, sf_dir), columns=MEASURES)


def prepare(rows: DataFrame) -> DataFrame:
    """Clean rows with their split and all features, from rows with a status."""
    return add_features(random_split(clean_rows(rows), key=KEY))


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What models are trained on and measured with, stored by split.

    A filter on ``split`` reads the files of that split alone.
    """
    build = lambda: prepare(flagged(spark, sf_dir))
    return written(spark, sf_dir, "prepared", build, ["split"]).select(
        KEY, *FEATURES, LABEL, "split"
    )
