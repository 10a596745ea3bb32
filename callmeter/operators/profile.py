"""Profiling a table: size, types, statistics, nulls, duplicates and distributions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmeter.functions.columns import content_digest, label_text
from callmeter.operators.ordered import SKETCH, cell_edges, running_totals, with_cells
from callmeter.operators.reshape import cell, one_row_per_column
from callmeter.schema import as_double, as_finite, as_number

QUARTILES = (0.25, 0.5, 0.75)
QUARTILE_NAMES = ("q1", "median", "q3")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns")
    )


def partitions(df: DataFrame) -> DataFrame:
    """Rows per input partition: how many there are, and how even."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count("*").alias("rows")
    )


def dtypes(df: DataFrame) -> DataFrame:
    """Position, name and type of each column, with how many values it holds."""
    present = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column"),
            F.lit(kind).alias("type"),
            F.col(c).alias("present"),
        )
        for i, (c, kind) in enumerate(df.dtypes, 1)
    ]
    return present.select(F.inline(F.array(*rows)))


def describe(df: DataFrame, *, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per column, as numbers."""
    # Five figures for many columns side by side would be too many fields for generated
    # code. Turned into (column, value) rows within the scan stage, they stay five, and
    # the partial aggregate leaves one row per column and task.
    v = F.col("value")
    return (
        df.select(*[as_double(c).alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value")
        .groupBy("column")
        .agg(
            F.count(v).alias("count"),
            F.avg(v).alias("mean"),
            F.stddev_samp(v).alias("stddev"),
            F.min(v).alias("min"),
            F.max(v).alias("max"),
        )
    )


def nulls(df: DataFrame) -> DataFrame:
    wide = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(cell(c, "nulls")) for c in df.columns]
    )
    return one_row_per_column(wide, df.columns, ["nulls"])


def duplicates(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and their difference, in one grouping by content.

    Rows are grouped by 128-bit digests, so 16 bytes of a row are shuffled whatever its width, and
    copies are counted before: a row repeated a billion times is shuffled once per task.
    """
    distinct = df.groupBy(content_digest(df).alias("content")).agg(F.count("*").alias("copies"))
    return distinct.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
    )


def class_distribution(df: DataFrame, *, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("count")).orderBy(label)


def correlation(
    df: DataFrame, *, columns: Sequence[str], handle_invalid: str = "error"
) -> DataFrame:
    """Pearson correlation of every pair of columns, one row per pair.

    Null between a constant column and another, or where fewer than two rows count. A missing
    value is a null or NaN: ``handle_invalid="error"`` raises on one, ``"skip"`` leaves its whole
    row out, ``"pairwise"`` leaves it out of the pairs of its column alone. An infinite value
    makes the correlations of its column null.

    Co-moments are plain sums of products, centred on the means that a first aggregate finds, so
    tasks add them up and one aggregate merges them. Only its result, a row of sums per column,
    passes through the driver.
    """
    if handle_invalid not in ("error", "skip", "pairwise"):
        raise ValueError(f"handle_invalid is 'error', 'skip' or 'pairwise', not {handle_invalid!r}")
    n = len(columns)
    plain = df.select(*[as_number(c).alias(f"x{i}") for i, c in enumerate(columns)])
    if handle_invalid == "skip":
        plain = plain.dropna()
    # Columns are turned into rows within the scan stage, as in describe().
    long = plain.unpivot([], plain.columns, "column", "value").groupBy("column")
    found = {r["column"]: r for r in long.agg(F.count("*").alias("rows"), F.count("value").alias("n"), F.avg("value").alias("mean")).collect()}
    holed = [c for i, c in enumerate(columns) if found and found[f"x{i}"]["n"] < found[f"x{i}"]["rows"]]
    if holed and handle_invalid == "error":
        raise ValueError(f"values are missing in {', '.join(holed)}; skip rows or take pairs")
    means = [found[f"x{i}"]["mean"] if found else None for i in range(n)]
    centres = [m if m is not None and math.isfinite(m) else 0.0 for m in means]
    sums = {r["i"]: r for r in _co_moments(plain, centres, gaps=bool(holed)).collect()}
    rows = found["x0"]["rows"] if found else 0

    def r(i: int, j: int) -> float | None:
        if i == j:
            return 1.0
        if i not in sums or j not in sums:
            return None
        if holed:
            count, sx, sy, sxx, syy = (sums[i][f"{name}{j}"] or 0 for name in ("n", "sx", "sy", "sxx", "syy"))
        else:  # centred on their own means, columns have no sums, and their squares are on the diagonal
            count, sx, sy, sxx, syy = rows, 0.0, 0.0, sums[i][f"sxy{i}"], sums[j][f"sxy{j}"]
        if count < 2:
            return None
        spread_x, spread_y = sxx - sx * sx / count, syy - sy * sy / count
        # Rounding leaves a constant column a spread in the last digits of its squares.
        if not (spread_x > sxx * 1e-13 and spread_y > syy * 1e-13):
            return None
        value = (sums[i][f"sxy{j}"] - sx * sy / count) / math.sqrt(spread_x * spread_y)
        return max(-1.0, min(1.0, value)) if math.isfinite(value) else None

    pairs = [(a, b, r(i, j)) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(pairs, "col_a string, col_b string, r double")


def _co_moments(plain: DataFrame, centres: Sequence[float], *, gaps: bool) -> DataFrame:
    """Per column ``i``, sums of its centred products with every column ``j``.

    With ``gaps`` also the count, sums and squares over the rows that have both.
    """
    n = len(centres)
    centred = plain.select(*[(F.col(f"x{i}") - F.lit(centres[i])).alias(f"d{i}") for i in range(n)])
    # A row becomes one row per column within the scan stage: few enough sums for generated code.
    turned = centred.select("*", F.posexplode(F.array(*centred.columns)).alias("i", "x")).where("x is not null")
    one, others = F.col("x"), [F.col(f"d{j}") for j in range(n)]
    sums = {"sxy": [one * o for o in others]}
    if gaps:
        both = [F.when(o.isNotNull(), one) for o in others]
        sums |= {"n": [F.when(o.isNotNull(), F.lit(1)) for o in others], "sx": both, "sy": others}
        sums |= {"sxx": [b * one for b in both], "syy": [o * o for o in others]}
    return turned.groupBy("i").agg(*[F.sum(v).alias(f"{name}{j}") for name, values in sums.items() for j, v in enumerate(values)])


def quantile_sketches(df: DataFrame, *, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A mergeable quantile sketch of the finite values of each column, by group.

    Returns ``by``, ``column``, ``values`` (how many) and ``sketch``. Sketches of parts of a table
    (days, regions, splits) can be kept and merged later without reading the rows again.
    """
    long = df.select(*by, *[as_finite(c).alias(c) for c in columns]).unpivot(list(by), list(columns), "column", "value")
    return long.groupBy(*by, "column").agg(
        F.count("value").alias("values"), F.kll_sketch_agg_double("value", F.lit(SKETCH)).alias("sketch")
    )


def merged_sketches(sketches: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of parts put together; ``by`` are the groups that stay apart."""
    return sketches.groupBy(*by, "column").agg(
        F.sum("values").alias("values"), F.kll_merge_agg_double("sketch").alias("sketch")
    )


def sketched_quantiles(sketches: DataFrame, *, quantiles: Sequence[float]) -> DataFrame:
    """One row per sketch and quantile, as ``quantile`` and ``value``; null where there are no values."""
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    values = F.when(F.col("values") > 0, F.kll_sketch_get_quantile_double("sketch", asked))
    keep = [c for c in sketches.columns if c != "sketch"]
    at = F.posexplode(F.coalesce(values, F.array_repeat(F.lit(None).cast("double"), len(quantiles)))).alias("_at", "value")
    return sketches.select(*keep, at).select(*keep, F.element_at(asked, F.col("_at") + 1).alias("quantile"), "value")


def histogram(df: DataFrame, *, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width bins from minimum to maximum of each column, empty bins included.

    Every bin holds its lower border, the last one also the maximum. Borders come from the finite
    values; the infinities count in the first and the last bin. A constant column gets a range
    of one around its value. Nulls and NaN are left out, so is a column without finite values.
    """
    wide = df.agg(
        *[
            f(as_finite(c)).alias(cell(c, m))
            for c in columns
            for m, f in (("low", F.min), ("high", F.max))
        ]
    )
    # Two numbers per column come back, and give its bin borders as constants.
    found = wide.first()
    borders = {}
    for c in columns:
        low, high = found[cell(c, "low")], found[cell(c, "high")]
        if low is None:
            continue
        if low == high:
            low, high = low - 0.5, high + 0.5
        width = (high - low) / bins
        borders[c] = [low + i * width for i in range(bins)] + [high]
    grid = df.sparkSession.createDataFrame(
        [
            (c, i, edges[i], n * bins + i)
            for n, (c, edges) in enumerate(borders.items())
            for i in range(bins)
        ],
        "column string, bin int, bin_start double, slot int",
    )
    # One short expression for all columns: fifteen of them side by side would outgrow
    # what the JVM compiles.
    entries = [
        entry
        for n, (c, edges) in enumerate(borders.items())
        for entry in (
            F.lit(n * bins),
            as_number(c),
            F.lit(edges[0]),
            F.lit((edges[-1] - edges[0]) / bins),
        )
    ]
    if not entries:
        return grid.select("column", "bin", "bin_start", F.lit(0).cast("long").alias("count"))
    value, low, width = F.col("value"), F.col("low"), F.col("width")
    guessed = (
        df.select(F.stack(F.lit(len(borders)), *entries).alias("first", "value", "low", "width"))
        .filter(value.isNotNull())
        .select(
            "*",
            F.greatest(F.lit(0), F.least(F.floor((value - low) / width), F.lit(bins - 1))).cast("int").alias("guess"),
        )
    )
    # A division can land a value one bin off its border; the borders decide. Column and
    # bin become one number, so the counting hashes integers only.
    guess = F.col("guess")
    off = F.when((guess > 0) & (value < low + guess * width), -1).otherwise(
        ((guess < bins - 1) & (value >= low + (guess + 1) * width)).cast("int")
    )
    counts = guessed.groupBy((F.col("first") + guess + off).alias("slot")).agg(
        F.count("*").alias("count")
    )
    return (
        grid.join(counts, "slot", "left")
        .select("column", "bin", "bin_start", "count")
        .fillna(0, subset=["count"])
    )


def _exact_quartiles(values: DataFrame) -> DataFrame:
    """Linear-interpolated quartiles per group from running totals of value counts."""
    last = F.col("n_total") - 1

    def at(position: Column) -> Column:
        holds = (F.col("n_before") <= position) & (position < F.col("n_before") + F.col("n"))
        return F.max(F.when(holds, F.col("value")))

    picks = []
    for i, q in enumerate(QUARTILES):
        place = last * F.lit(q)
        picks += [
            at(F.floor(place)).alias(f"_low{i}"),
            at(F.ceil(place)).alias(f"_high{i}"),
            F.max(place - F.floor(place)).alias(f"_part{i}"),
        ]
    found = values.groupBy("column", "class").agg(F.sum("n").alias("count"), *picks)
    return found.select(
        "column",
        "class",
        "count",
        *[
            (
                F.col(f"_low{i}")
                + (F.col(f"_high{i}") - F.col(f"_low{i}")) * F.col(f"_part{i}")
            ).alias(name)
            for i, name in enumerate(QUARTILE_NAMES)
        ],
    )


def box_stats(
    df: DataFrame,
    *,
    columns: Sequence[str],
    by: str,
    whisker: float = 1.5,
    approx: bool = False,
    cells: int | None = None,
) -> DataFrame:
    """Quartiles, whisker ends and outlier count of each column within each class.

    ``by`` is a boolean or 0/1 label and is reported as its class name. Whiskers end at
    the outermost values within ``whisker`` times the interquartile range, and at the
    quartile itself if there are none. Quartiles are exact whatever the number of distinct
    values; ``approx`` trades that for a single sketch pass.
    """
    source = df.select(
        label_text(F.col(by)).alias("class"), *[as_number(c).alias(c) for c in columns]
    )
    marks = [cell(c, "cell") for c in columns]
    if approx:
        values = _values(source, columns).withColumn("n", F.lit(1).cast("long"))
        sketch = F.percentile_approx("value", list(QUARTILES), 10000)
        quartiles = (
            values.groupBy("column", "class")
            .agg(F.count("*").alias("count"), sketch.alias("_q"))
            .select(
                "column",
                "class",
                "count",
                *[F.col("_q")[i].alias(name) for i, name in enumerate(QUARTILE_NAMES)],
            )
        )
    else:
        edges = cell_edges(source, columns, cells=cells)
        values = (
            _values(with_cells(source, columns, marks, edges), columns, marks)
            .groupBy("column", "class", "cell", "value")
            .agg(F.count("*").alias("n"))
        )
        quartiles = _exact_quartiles(
            running_totals(
                values,
                value="value",
                cell="cell",
                amounts=["n"],
                groups=["column", "class"],
            )
        )
    reach = whisker * (F.col("q3") - F.col("q1"))
    fenced = quartiles.select(
        "*", (F.col("q1") - reach).alias("_floor"), (F.col("q3") + reach).alias("_ceiling")
    )
    # At most one row per column and class name, and there are two class names.
    held = values.join(F.broadcast(fenced), ["column", "class"])
    value = F.col("value")
    inside = value.between(F.col("_floor"), F.col("_ceiling"))
    ends = held.groupBy("column", "class", "count", *QUARTILE_NAMES).agg(
        F.min(F.when(value >= F.col("_floor"), value)).alias("_low"),
        F.max(F.when(value <= F.col("_ceiling"), value)).alias("_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
    )
    return ends.select(
        "column",
        "class",
        "count",
        *QUARTILE_NAMES,
        F.least("_low", "q1").alias("whisker_low"),
        F.greatest("_high", "q3").alias("whisker_high"),
        "outliers",
    )


def _values(
    df: DataFrame, columns: Sequence[str], marks: Sequence[str] | None = None
) -> DataFrame:
    """One row per class, column and value; nulls are left out."""
    pairs = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(c).alias("value"),
            *([F.col(marks[i]).alias("cell")] if marks else []),
        )
        for i, c in enumerate(columns)
    ]
    return df.select("class", F.inline(F.array(*pairs))).filter(
        F.col("class").isNotNull() & F.col("value").isNotNull()
    )
