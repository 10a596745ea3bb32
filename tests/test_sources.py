import pytest
from pyspark.sql import functions as F

from callmeter.schema import RECORD, SOURCE_SCHEMA, USAGE_SCHEMA, snake_names
from callmeter.sources import folders, usage_io
from callmeter.sources.scratch import scratch_path


@pytest.fixture(scope="module")
def table(spark):
    kinds = {f.name: f.dataType for f in USAGE_SCHEMA}
    value = {"string": F.concat(F.lit("555-"), F.col("id").cast("string")), "boolean": F.col("id") % 3 == 0}
    return spark.range(50).select(
        *[
            value.get(t.simpleString(), (F.col("id") * 1.5 if t.simpleString() == "double" else F.col("id")).cast(t)).alias(c)
            for c, t in kinds.items()
        ]
    )


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_csv_with_and_without_schema(spark, table, tmp_path):
    path = str(tmp_path / "csv")
    usage_io.write_csv(table, path)
    typed = usage_io.read_usage_csv(spark, path, schema=USAGE_SCHEMA)
    assert typed.dtypes == table.dtypes
    assert same(typed, table)
    assert same(usage_io.read_usage_csv(spark, path), table)


def test_title_case_header(spark, table, tmp_path):
    path = str(tmp_path / "titles")
    usage_io.write_csv(table.toDF(*SOURCE_SCHEMA.names), path)
    found = snake_names(usage_io.read_usage_csv(spark, path, schema=SOURCE_SCHEMA))
    assert found.columns == RECORD and same(found, table)


def test_reordered_header_raises(spark, table, tmp_path):
    path = str(tmp_path / "reordered")
    usage_io.write_csv(table.select(*reversed(RECORD)).limit(2), path)
    with pytest.raises(Exception, match="header"):
        usage_io.read_usage_csv(spark, path, schema=USAGE_SCHEMA).collect()


def test_parquet_is_snappy_and_prunes_splits(spark, table, tmp_path):
    path = str(tmp_path / "parts")
    split = F.when(F.col("account_length") % 2 == 0, "train").otherwise("val")
    usage_io.write_usage(table.withColumn("split", split), path, partition_by=["split"])
    files = [f.name for f in (tmp_path / "parts").rglob("*.parquet")]
    assert files and all(".snappy." in f for f in files)
    one = usage_io.read_usage(spark, path).filter("split = 'val'")
    assert one.count() == 25
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    usage_io.write_usage(table, path)
    assert usage_io.read_usage(spark, path).count() == 50  # replaced, not appended


def test_storage_report(spark, table, tmp_path):
    report = usage_io.storage_report(table.coalesce(1), str(tmp_path / "both"))
    r = report.first()
    size = lambda kind: sum(f.stat().st_size for f in (tmp_path / "both" / kind).glob(f"*.{kind}"))
    assert (r["csv_rows"], r["parquet_rows"]) == (50, 50)
    assert (r["csv_files"], r["parquet_files"]) == (1, 1)
    assert (r["csv_bytes"], r["parquet_bytes"]) == (size("csv"), size("parquet"))
    assert r["size_ratio"] == size("csv") / size("parquet")
    lines = [x["value"] for x in usage_io.storage_text(report).collect()]
    assert lines[1] == "Dataset: 50 rows" and lines[4].startswith("Size gain: ")


def test_sizes_are_read_without_content(spark, table, tmp_path):
    usage_io.write_csv(table, str(tmp_path / "c"))
    files = usage_io._files(spark, str(tmp_path / "c"), "*.csv", "csv")
    schema = files._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1]
    assert schema.startswith("struct<length:bigint>")


def test_scratch_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(shared)


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Cluster:
        class conf:
            get = staticmethod(lambda name, default=None: None)

        class sparkContext:
            master = "spark://head:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Cluster, "x")


@pytest.mark.parametrize(
    "master, warehouse, good",
    [
        ("spark://head:7077", "file:/tmp/warehouse", False),
        ("spark://head:7077", "/tmp/warehouse", False),
        ("local-cluster[3,2,1000]", "file:/tmp/warehouse", False),
        ("spark://head:7077", "hdfs://store/warehouse", True),
        ("local[4]", "file:/tmp/warehouse", True),
        ("local", "/tmp/warehouse", True),
    ],
)
def test_scratch_below_the_warehouse_only_where_it_is_shared(monkeypatch, master, warehouse, good):
    class Session:
        class conf:
            get = staticmethod(lambda name, default=None: warehouse if "warehouse" in name else default)

        class sparkContext:
            applicationId = "app-1"

    Session.sparkContext.master = master
    announced = []
    monkeypatch.setattr(folders, "remove_at_end", lambda spark, path: announced.append(path))
    if not good:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(Session, "x")
        return
    assert scratch_path(Session, "x").startswith(f"{warehouse}/callmeter/app-1/x-")
    assert announced in ([f"{warehouse}/callmeter/app-1"], [])


def test_scratch_goes_when_the_application_ends(tmp_path):
    import subprocess
    import sys

    code = f"""
from pyspark.sql import SparkSession
from callmeter.sources.scratch import scratch_path
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
spark.range(3).write.parquet(path := scratch_path(spark, "x"))
print("ROWS", spark.read.parquet(path).count())
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd="/root/repo")
    assert "ROWS 3" in done.stdout
    assert list((tmp_path / "callmeter").iterdir()) == []


def _texts(spark, path):
    return [spark.read.text(p).first()[0] for p in path]


def test_publication_changes_as_a_whole(spark, tmp_path):
    place = folders.Publication(spark, str(tmp_path / "root"))
    write = lambda text: lambda path: spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    assert place.current() == {}
    place.publish({"a": write("a1"), "b": write("b1")})
    place.publish({"a": None, "b": write("b2")})
    assert _texts(spark, place.current().values()) == ["a1", "b2"]

    def lost(path):
        write("half")(path)
        raise RuntimeError("the writer is lost")

    with pytest.raises(RuntimeError, match="lost"):
        place.publish({"a": write("a3"), "b": lost})
    assert _texts(spark, place.current().values()) == ["a1", "b2"]
    assert len(folders.names(spark, place.root)) == 5  # what the lost writer left
    place.publish({"a": write("a4"), "b": None})
    assert _texts(spark, place.current().values()) == ["a4", "b2"]
    assert len(folders.names(spark, place.root)) == 3


def test_a_lost_move_of_the_pointer_changes_nothing(spark, tmp_path, monkeypatch):
    place = folders.Publication(spark, str(tmp_path / "root"))
    write = lambda text: lambda path: spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    place.publish({"a": write("a1")})
    real = folders.write_text

    def cut(spark, path, text):
        real(spark, path, text[:5])
        raise RuntimeError("the writer is lost")

    monkeypatch.setattr(folders, "write_text", cut)
    with pytest.raises(RuntimeError, match="lost"):
        place.publish({"a": write("a2")})
    assert _texts(spark, place.current().values()) == ["a1"]


def test_no_model_without_a_pointer(spark, tmp_path):
    from pyspark.ml import PipelineModel

    PipelineModel(stages=[]).save(str(tmp_path / "root" / "model-half"))
    with pytest.raises(FileNotFoundError, match="no complete model"):
        usage_io.load_model(str(tmp_path / "root"))


def test_conversion_reads_once_and_keeps_rejects_apart(spark, table, tmp_path):
    from callmeter.plans import stages

    path = lambda name: str(tmp_path / name)
    usage_io.write_csv(table.toDF(*SOURCE_SCHEMA.names).coalesce(1), path("clean.csv"))
    files = list((tmp_path / "clean.csv").glob("*.csv"))
    lines = files[0].read_text().splitlines()
    report = stages.convert(spark, path("clean.csv"), path("clean"))
    row = report.first()
    assert (row["csv_rows"], row["parquet_rows"], row["rejected"]) == (50, 50, 0)
    assert not (tmp_path / "clean_rejects").exists() and same(usage_io.read_usage(spark, path("clean")), table)

    cells = lines[3].split(",")
    faulty = [
        *lines[:3],
        ",".join([*cells[:3], "many", *cells[4:]]),  # a word for a number
        ",".join([*cells[:1], "1.5", *cells[2:-1], "maybe"]),  # no whole number, no boolean
        ",".join(cells[:-2]),  # too short
        lines[4] + ",extra",
        '"' + lines[5],  # an open quote
        ",".join([*cells[:3], "", *cells[4:]]),  # an empty cell is no fault
        *lines[6:],
    ]
    folder = tmp_path / "odd"
    folder.mkdir()
    (folder / "one.TXT").write_text("\n".join(faulty) + "\n")
    row = stages.convert(spark, str(folder), path("odd.out")).first()
    assert (row["csv_rows"], row["rejected"], row["parquet_rows"]) == (len(faulty) - 1, 5, len(faulty) - 6)
    assert (row["csv_files"], row["csv_bytes"]) == (1, (folder / "one.TXT").stat().st_size)
    rejects = {r["record"]: r["faults"] for r in usage_io.read_usage(spark, path("odd.out_rejects")).collect()}
    assert sorted(map(tuple, rejects.values())) == sorted(
        [("Day Mins",), ("Account Length", "Churn"), ("_record",), ("_record",), ("_record",)]
    )
    assert faulty[5] in rejects and faulty[6] in rejects


def test_sizes_of_compressed_files(spark, table, tmp_path):
    table.write.option("header", True).option("compression", "gzip").csv(str(tmp_path / "gz"))
    usage_io.write_usage(table, str(tmp_path / "parquet"))
    r = usage_io.compare_storage(spark, str(tmp_path / "gz"), str(tmp_path / "parquet"), csv_rows=50, parquet_rows=50).first()
    sizes = [f.stat().st_size for f in (tmp_path / "gz").glob("*.csv.gz")]
    assert (r["csv_files"], r["csv_bytes"]) == (len(sizes), sum(sizes))


def test_one_scan_of_the_csv(spark, table, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameReader

    usage_io.write_csv(table, str(tmp_path / "c"))
    reads, real = [], DataFrameReader.csv
    monkeypatch.setattr(DataFrameReader, "csv", lambda self, *a, **b: reads.append(1) or real(self, *a, **b))
    usage_io.convert_csv(spark, str(tmp_path / "c"), str(tmp_path / "p"), schema=USAGE_SCHEMA).collect()
    assert len(reads) == 1


def _copied(tmp_path):
    import shutil

    from conftest import SF_DIR

    for name in ("orders", "lineitem", "events"):
        shutil.copy(f"{SF_DIR}/{name}.parquet", tmp_path / f"{name}.parquet")
        (tmp_path / f"{name}.parquet").chmod(0o644)
    return str(tmp_path)


def test_stored_tables_follow_their_source(spark, tmp_path):
    from callmeter.plans import usage_table

    sf_dir = _copied(tmp_path)
    first = usage_table.records(spark, sf_dir)
    assert usage_table.records(spark, sf_dir).inputFiles() == first.inputFiles()
    n = first.count()
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").orderBy("o_orderkey").limit(n // 2).toPandas()
    orders.to_parquet(f"{sf_dir}/orders.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    spark.catalog.refreshByPath(f"{sf_dir}/orders.parquet")
    again = usage_table.records(spark, sf_dir)
    assert again.count() == n // 2 and set(again.inputFiles()).isdisjoint(first.inputFiles())


def test_a_stored_table_that_lost_a_file_is_made_anew(spark, tmp_path):
    from pathlib import Path

    from callmeter.plans import usage_table

    sf_dir = _copied(tmp_path)
    first = usage_table.records(spark, sf_dir)
    n, files = first.count(), first.inputFiles()
    Path(files[0].removeprefix("file://")).unlink()
    again = usage_table.records(spark, sf_dir)
    assert again.count() == n and again.inputFiles() != files


def test_scores_belong_to_one_model(spark):
    from callmeter.operators import models
    from callmeter.plans import catalog
    from conftest import SF_DIR

    rows = catalog.prepared(spark, SF_DIR).filter("split = 'train'")
    fits = [models.fit_forest(rows, columns=["day_mins", "custserv_calls"], trees=2, depth=d) for d in (1, 3)]
    files = [catalog.model_scores(spark, SF_DIR, "x", m).inputFiles() for m in fits]
    assert set(files[0]).isdisjoint(files[1])
