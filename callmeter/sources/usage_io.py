"""Reading and writing usage tables, small results, reports and fitted models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callmeter.schema import snake
from callmeter.sources.folders import Publication


def read_usage_csv(
    spark: SparkSession, path: str, *, schema: T.StructType | None = None
) -> DataFrame:
    """Read CSV with a header.

    With a schema the file is read once and its header must name the columns in that
    order (a reordered header raises instead of shifting values). Without one, Spark
    infers the types in an extra pass over the file.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_usage(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet folder; a ``split`` partition column is recovered from its path."""
    return spark.read.parquet(path)


def write_usage(
    df: DataFrame,
    path: str,
    *,
    partition_by: list[str] | None = None,
    codec: str = "snappy",
) -> None:
    """Write Parquet, replacing what is there.

    Partitioned output needs no shuffle: each task writes one file per split value it
    holds, and the values are few.
    """
    df.write.mode("overwrite").option("compression", codec).parquet(
        path, partitionBy=partition_by
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


#: Column of a parsed row that names its faults, and the fault of a line that is no row.
FAULTS, BAD_RECORD = "_faults", "_record"


def parsed_csv(
    spark: SparkSession, path: str, schema: T.StructType, *, header: bool = True
) -> DataFrame:
    """Read CSV cell by cell: typed columns, and what is wrong with each row.

    Adds ``_record``, the line itself if it does not have the schema's cells (too few or many,
    an open quote), and ``_faults``, the names of the columns whose cell is not of their type,
    or ``_record``. Such a cell is null. Numbers are plain, booleans are true or false in any
    case; empty cells are null and no fault. The header must name the columns in order.
    """
    cells = T.StructType([*(T.StructField(f.name, T.StringType()) for f in schema), T.StructField(BAD_RECORD, T.StringType())])
    reader = spark.read.option("header", header).option("enforceSchema", False).option("columnNameOfCorruptRecord", BAD_RECORD)
    # All cells are looked at, whichever columns are asked for later.
    rows = reader.option("mode", "PERMISSIVE").option("columnPruning", False).schema(cells).csv(path)

    def value(field: T.StructField) -> Column:
        cell = F.trim(F.col(f"`{field.name}`"))
        if isinstance(field.dataType, T.StringType):
            return F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.BooleanType):
            return F.when(F.lower(cell) == "true", True).when(F.lower(cell) == "false", False)
        return cell.try_cast(field.dataType)

    whole = F.col(BAD_RECORD).isNull()
    typed = [F.when(whole, value(f)).alias(f.name) for f in schema]
    wrong = [F.when((F.trim(F.col(f"`{f.name}`")) != "") & value(f).isNull(), F.lit(f.name)) for f in schema]
    named = F.filter(F.array(*wrong), lambda name: name.isNotNull())
    return rows.select(*typed, BAD_RECORD, F.when(whole, named).otherwise(F.array(F.lit(BAD_RECORD))).alias(FAULTS), F.to_json(F.struct(*[f"`{f.name}`" for f in schema])).alias("_cells"))


def good_rows(parsed: DataFrame) -> DataFrame:
    """Rows without a fault."""
    return parsed.where(F.size(FAULTS) == 0).drop(BAD_RECORD, FAULTS, "_cells")


def rejects(parsed: DataFrame) -> DataFrame:
    """Rows with a fault, as ``faults`` and ``record``: the line, or its cells as JSON."""
    return parsed.where(F.size(FAULTS) > 0).select(F.col(FAULTS).alias("faults"), F.coalesce(BAD_RECORD, "_cells").alias("record"))


def reject_counts(parsed: DataFrame) -> DataFrame:
    """How many rows have a fault, by fault; a row with several counts for each."""
    return parsed.select(F.explode(FAULTS).alias("fault")).groupBy("fault").agg(F.count("*").alias("rows"))


def convert_csv(
    spark: SparkSession, csv_path: str, out: str, *, schema: T.StructType, rejected: str | None = None, header: bool = True
) -> DataFrame:
    """CSV to Parquet in one pass; rows with a fault go to ``rejected`` (``<out>_rejects``).

    Rows and rejects are counted by the write itself. Only if there are rejects, a second pass
    writes them. Returns the storage comparison with the number of rows rejected.
    """
    parsed, seen = parsed_csv(spark, csv_path, schema, header=header), Observation()
    counted = parsed.observe(seen, F.count("*").alias("rows"), F.count_if(F.size(FAULTS) > 0).alias("rejected"))
    good = good_rows(counted)
    write_usage(good.toDF(*[snake(c) for c in good.columns]), out)
    found = seen.get
    if found["rejected"]:
        write_usage(rejects(parsed), rejected or f"{out.rstrip('/')}_rejects")
    report = compare_storage(spark, csv_path, out, csv_rows=found["rows"], parquet_rows=found["rows"] - found["rejected"])
    return report.withColumn("rejected", F.lit(found["rejected"]))


def _files(spark: SparkSession, path: str, pattern: str, form: str) -> DataFrame:
    # Only path and length are selected, so no file content is read.
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.lit(form).alias("form"),
            F.lit(1).cast("long").alias("files"),
            F.col("length").alias("bytes"),
        )
    )


def storage_report(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as CSV and as Parquet below ``path`` and compare the two."""
    rows = {}
    for form, write in (("csv", write_csv), ("parquet", write_usage)):
        seen = Observation()
        write(df.observe(seen, F.count("*").alias("rows")), f"{path}/{form}")
        rows[f"{form}_rows"] = seen.get["rows"]
    return compare_storage(df.sparkSession, f"{path}/csv", f"{path}/parquet", **rows)


def compare_storage(
    spark: SparkSession, csv_path: str, parquet_path: str, *, csv_rows: int, parquet_rows: int
) -> DataFrame:
    """The same table in both forms, side by side; the row counts come from the writes.

    One row: rows, files and bytes of each form, CSV/Parquet size ratio and the percentage
    saved. Every data file below a path counts, whatever its ending; none is opened.
    """
    parts = _files(spark, csv_path, "*", "csv").unionByName(_files(spark, parquet_path, "*", "parquet"))
    totals = parts.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("form") == form, F.col(what))), F.lit(0)).alias(f"{form}_{what}")
            for form in ("csv", "parquet")
            for what in ("files", "bytes")
        ]
    )
    csv_bytes, parquet_bytes = F.col("csv_bytes"), F.col("parquet_bytes")
    rows = {"csv_rows": csv_rows, "parquet_rows": parquet_rows}
    return totals.select(
        *[F.lit(n).cast("long").alias(name) for name, n in rows.items()],
        "*",
        F.when(parquet_bytes > 0, csv_bytes / parquet_bytes)
        .otherwise(0.0)
        .alias("size_ratio"),
        F.when(csv_bytes > 0, (1 - parquet_bytes / csv_bytes) * 100)
        .otherwise(0.0)
        .alias("size_gain_pct"),
    )


def storage_text(report: DataFrame) -> DataFrame:
    """The report as lines of text, ready for ``df.write.text``."""
    kib = lambda c: F.col(c) / 1024
    lines = F.array(
        F.lit("CSV vs PARQUET (Snappy)"),
        F.format_string("Dataset: %d rows", F.col("parquet_rows")),
        F.format_string(
            "CSV: %.1f KiB in %d files", kib("csv_bytes"), F.col("csv_files")
        ),
        F.format_string(
            "Parquet: %.1f KiB in %d files",
            kib("parquet_bytes"),
            F.col("parquet_files"),
        ),
        F.format_string(
            "Size gain: %.1f%% (ratio %.1fx)",
            F.col("size_gain_pct"),
            F.col("size_ratio"),
        ),
        F.lit("Compression: Snappy"),
    )
    return report.select(F.explode(lines).alias("value"))


def save_model(model: PipelineModel, path: str) -> None:
    """Save a model; one that is there already stays readable until the new one is complete."""
    Publication(SparkSession.active(), path).publish({"model": model.save})


def load_model(path: str) -> PipelineModel:
    """The last model that was saved completely."""
    found = Publication(SparkSession.active(), path).current()
    if "model" not in found:
        raise FileNotFoundError(f"{path}: no complete model")
    return PipelineModel.load(found["model"])
