import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from callmeter.schema import KEY, LABEL, MEASURES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def usage_rows(spark):
    """Builds a labelled usage frame from dicts; what a row leaves out is 1."""

    def build(*rows):
        kinds = {c: "double" if c.endswith(("mins", "charge")) else "int" for c in MEASURES}
        schema = ", ".join(
            [f"{KEY} bigint", *(f"{c} {k}" for c, k in kinds.items()), f"{LABEL} int"]
        )
        full = []
        for i, row in enumerate(rows):
            base = {c: 1.0 if k == "double" else 1 for c, k in kinds.items()}
            values = {KEY: i, **base, LABEL: 0, **row}
            full.append(tuple(values[c] for c in (KEY, *MEASURES, LABEL)))
        return spark.createDataFrame(full, schema)

    return build
