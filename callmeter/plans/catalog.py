"""The registered queries: each operator on the derived usage table, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmeter.functions.columns import FOREST_THRESHOLD, any_of, decide, sigmoid
from callmeter.operators import (
    checks,
    clean,
    evaluate,
    features,
    models,
    profile,
    score,
    split,
)
from callmeter.plans import oracle as sql
from callmeter.plans.usage_table import (
    flagged,
    incomplete,
    labelled,
    prepare,
    prepared,
    records,
    source_state,
    usage,
    written,
)
from callmeter.schema import (
    DERIVED,
    FEATURES,
    IDENTIFIER,
    KEY,
    LABEL,
    MEASURES,
    PREDICTION_SCHEMA,
    RECORD,
    USAGE_SCHEMA,
)
from callmeter.sources import folders, usage_io
from callmeter.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLE[f.__name__] = oracle
        return f

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def rounded_sql(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


@query(sql.statement("usage", f"SELECT account_id, {', '.join(RECORD)} FROM usage"))
def usage_table(spark, sf_dir):
    """The derivation itself; all other queries read its stored result."""
    return usage(spark, sf_dir)


# --- Sources and sinks ---------------------------------------------------------------

_RECORDS = sql.statement("usage", f"SELECT {', '.join(RECORD)} FROM usage")


def _written_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "records-csv")
    usage_io.write_csv(records(spark, sf_dir).select(*RECORD), path)
    return path


@query(_RECORDS)
def csv_infer_roundtrip(spark, sf_dir):
    return usage_io.read_usage_csv(spark, _written_csv(spark, sf_dir))


@query(_RECORDS)
def csv_typed_roundtrip(spark, sf_dir):
    return usage_io.read_usage_csv(spark, _written_csv(spark, sf_dir), schema=USAGE_SCHEMA)


@query(_RECORDS)
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "records")
    usage_io.write_usage(records(spark, sf_dir).select(*RECORD), path)
    return usage_io.read_usage(spark, path)


@query(
    sql.statement(
        "prepared", f"SELECT account_id, churn, split, {sql.FEATURE_LIST} FROM prepared"
    )
)
def parquet_partitioned_by_split(spark, sf_dir):
    path = scratch_path(spark, "splits")
    usage_io.write_usage(prepare(flagged(spark, sf_dir)), path, partition_by=["split"])
    return usage_io.read_usage(spark, path).select(KEY, LABEL, "split", *FEATURES)


@query(
    sql.statement(
        "scored",
        f"""SELECT account_id AS client_id, {sql.as_spark_rounds('score', 4)} AS mlp_prob,
  {sql.as_spark_rounds('score_b', 4)} AS rf_prob,
  {sql.as_spark_rounds('(score + score_b) / 2', 4)} AS ensemble_prob,
  CASE WHEN (score + score_b) / 2 < 0.25 THEN 'low' WHEN (score + score_b) / 2 < 0.45 THEN 'moderate'
    WHEN (score + score_b) / 2 < 0.65 THEN 'high' ELSE 'critical' END AS risk_level,
  CASE WHEN (score + score_b) / 2 < 0.25 THEN 'No action needed'
    WHEN (score + score_b) / 2 < 0.45 THEN 'Watch: monthly follow-up'
    WHEN (score + score_b) / 2 < 0.65 THEN 'Targeted retention offer'
    ELSE 'Priority contact: urgent personal offer' END AS action,
  CAST((score + score_b) / 2 >= 0.4 AS INT) AS predicted
FROM scored""",
    )
)
def predictions_csv_roundtrip(spark, sf_dir):
    both = ["mlp_prob", "rf_prob"]
    scored = scored_rows(spark, sf_dir).select(
        F.col(KEY).alias("client_id"),
        F.col("score").alias("mlp_prob"),
        F.col("score_b").alias("rf_prob"),
    )
    table = score.score_table(score.ensemble(scored, scores=both), score="ensemble_prob")
    table = score.round_scores(table, scores=[*both, "ensemble_prob"])
    path = scratch_path(spark, "predictions")
    usage_io.write_csv(table.select(*PREDICTION_SCHEMA.names), path)
    return usage_io.read_usage_csv(spark, path, schema=PREDICTION_SCHEMA)


def _sizes(spark: SparkSession, path: str) -> tuple[int, int]:
    """Files and bytes as the file system lists them."""
    lengths = [length for length, _ in folders.files(spark, path).values()]
    return len(lengths), sum(lengths)


@query(
    sql.statement(
        "usage",
        """SELECT count(*) AS csv_rows, count(*) AS parquet_rows, true AS sizes_agree,
  true AS gain_agrees FROM usage""",
    )
)
def storage_report(spark, sf_dir):
    path = scratch_path(spark, "storage")
    report = usage_io.storage_report(records(spark, sf_dir).select(*RECORD), path)
    (csv_files, csv_bytes), (files, size) = _sizes(spark, f"{path}/csv"), _sizes(spark, f"{path}/parquet")
    c = F.col
    listed = (c("csv_files") == csv_files) & (c("csv_bytes") == csv_bytes) & (c("parquet_files") == files)
    return report.select(
        "csv_rows",
        "parquet_rows",
        (listed & (c("parquet_bytes") == size) & F.lit(files > 0)).alias("sizes_agree"),
        (F.abs(c("size_gain_pct") - (100 - 100 * size / csv_bytes)) < 1e-9).alias("gain_agrees"),
    )


@query(
    sql.statement(
        "usage",
        """SELECT CAST(unnest(range(1, 7)) AS INT) AS line, unnest(['CSV vs PARQUET (Snappy)', 'Dataset: ' || n || ' rows',
  'as listed', 'as listed', 'as listed', 'Compression: Snappy']) AS text FROM (SELECT count(*) AS n FROM usage)""",
    )
)
def storage_text(spark, sf_dir):
    """The report's lines; those on sizes read "as listed" if they are what the file system says."""
    path, text = scratch_path(spark, "storage"), scratch_path(spark, "storage-text")
    report = usage_io.storage_report(records(spark, sf_dir).select(*RECORD), path)
    usage_io.storage_text(report).coalesce(1).write.text(text)
    (csv_files, csv_bytes), (files, size) = _sizes(spark, f"{path}/csv"), _sizes(spark, f"{path}/parquet")
    listed = [
        f"CSV: {csv_bytes / 1024:.1f} KiB in {csv_files} files",
        f"Parquet: {size / 1024:.1f} KiB in {files} files",
        f"Size gain: {100 - 100 * size / csv_bytes:.1f}% (ratio {csv_bytes / size:.1f}x)",
    ]
    line = F.col("line")
    wanted = F.when(line == 3, listed[0]).when(line == 4, listed[1]).when(line == 5, listed[2])
    # Six lines of one small file.
    lines = spark.read.text(text, wholetext=True).select(F.posexplode(F.split(F.trim("value"), "\n")).alias("at", "value"))
    lines = lines.where("value <> ''").select((F.col("at") + 1).alias("line"), "value")
    return lines.select("line", F.when(F.col("value") == wanted, "as listed").otherwise(F.col("value")).alias("text"))


_BAD_CELL, _SHORT, _QUOTE = "account_id % 97 = 0", "account_id % 101 = 0", "account_id % 103 = 0"


def _faulty_lines(spark: SparkSession, sf_dir: str) -> str:
    """The records as CSV lines, some with a word for a number, without their last cells, or with an open quote."""
    rows = records(spark, sf_dir)
    cell = lambda c: F.when(F.expr(_BAD_CELL), F.lit("many")) if c in ("day_mins", "eve_calls") else F.lit(None)
    cells = F.array(*[F.coalesce(cell(c), F.col(c).cast("string")) for c in RECORD])
    line = F.array_join(F.when(F.expr(_SHORT), F.slice(cells, 1, len(RECORD) - 2)).otherwise(cells), ",")
    path = scratch_path(spark, "faulty-csv")
    rows.select(F.when(F.expr(_QUOTE), F.concat(F.lit('"'), line)).otherwise(line).alias("value")).write.text(path)
    return path


@query(
    sql.statement(
        "usage",
        f"""SELECT fault, count(*) AS "rows" FROM (
  SELECT '{usage_io.BAD_RECORD}' AS fault FROM usage WHERE {_SHORT} OR {_QUOTE}
  UNION ALL SELECT unnest(['day_mins', 'eve_calls']) FROM usage WHERE {_BAD_CELL} AND NOT ({_SHORT} OR {_QUOTE})
) GROUP BY fault""",
    )
)
def csv_rejects(spark, sf_dir):
    """Rejected rows by fault, from the rejects that a conversion leaves behind."""
    out = scratch_path(spark, "converted")
    usage_io.convert_csv(spark, _faulty_lines(spark, sf_dir), out, schema=USAGE_SCHEMA, header=False)
    left = usage_io.read_usage(spark, f"{out}_rejects")
    return usage_io.reject_counts(left.withColumnRenamed("faults", usage_io.FAULTS))


@query(
    sql.statement(
        "usage",
        f"""SELECT {', '.join(RECORD)} FROM usage WHERE NOT ({_BAD_CELL} OR {_SHORT} OR {_QUOTE})""",
    )
)
def csv_good_rows(spark, sf_dir):
    out = scratch_path(spark, "converted")
    usage_io.convert_csv(spark, _faulty_lines(spark, sf_dir), out, schema=USAGE_SCHEMA, header=False)
    return usage_io.read_usage(spark, out)


# --- Profiling -----------------------------------------------------------------------


@query(sql.statement("usage", 'SELECT count(*) AS "rows", 18 AS "columns" FROM usage'))
def profile_shape(spark, sf_dir):
    return profile.shape(records(spark, sf_dir))


@query(
    'SELECT count(*) AS "rows", true AS has_partitions FROM lineitem'
)
def profile_partitions(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return profile.partitions(lines).agg(
        F.sum("rows").alias("rows"), (F.count("*") > 0).alias("has_partitions")
    )


_KINDS = {KEY: "bigint", **{f.name: f.dataType.simpleString() for f in USAGE_SCHEMA}}


@query(
    sql.statement(
        "usage",
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", {i} AS \"position\", '{k}' AS \"type\","
            f" count({c}) AS present FROM usage"
            for i, (c, k) in enumerate(_KINDS.items(), 1)
        ),
    )
)
def profile_dtypes(spark, sf_dir):
    return profile.dtypes(records(spark, sf_dir))


_DESCRIBE = (
    "count({c}) AS \"count\", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,"
    " CAST(min({c}) AS DOUBLE) AS \"min\", CAST(max({c}) AS DOUBLE) AS \"max\""
)


@query(sql.statement("base", sql.per_column("base", [*MEASURES, LABEL], _DESCRIBE)))
def profile_describe(spark, sf_dir):
    found = profile.describe(labelled(spark, sf_dir), columns=[*MEASURES, LABEL])
    return rounded(found, "mean", "stddev")


@query(
    sql.statement(
        "usage",
        sql.per_column(
            "usage", [KEY, *RECORD], "CAST(count(*) - count({c}) AS BIGINT) AS nulls"
        ),
    )
)
def profile_nulls(spark, sf_dir):
    return profile.nulls(records(spark, sf_dir))


@query(
    sql.statement(
        "base",
        f"""SELECT CAST(sum(n) AS BIGINT) AS "rows", count(*) AS distinct_rows,
  CAST(sum(n - 1) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS n FROM base GROUP BY {sql.MEASURE_LIST}, churn)""",
    )
)
def profile_duplicates(spark, sf_dir):
    return profile.duplicates(labelled(spark, sf_dir).drop(KEY))


@query(sql.statement("usage", 'SELECT churn, count(*) AS "count" FROM usage GROUP BY churn'))
def class_distribution(spark, sf_dir):
    return profile.class_distribution(records(spark, sf_dir), label=LABEL)


@query(
    sql.statement(
        "base",
        "SELECT u.col_a, u.col_b, round(u.r, 6) AS r FROM (SELECT "
        + ", ".join(f"corr({a}, {b}) AS {a}__{b}" for a in MEASURES for b in MEASURES)
        + " FROM base) w, LATERAL (VALUES "
        + ", ".join(f"('{a}', '{b}', w.{a}__{b})" for a in MEASURES for b in MEASURES)
        + ") u(col_a, col_b, r)",
    )
)
def correlation_long(spark, sf_dir):
    return rounded(profile.correlation(labelled(spark, sf_dir), columns=MEASURES), "r")


@query(
    sql.statement(
        "base",
        f"""SELECT col AS "column", CAST(bin AS INT) AS bin, lo + bin * w AS bin_start,
  CAST(count(v) AS BIGINT) AS "count"
FROM (SELECT col, lo, hi, (hi - lo) / 30 AS w, unnest(range(30)) AS bin
      FROM (SELECT col, min(v) AS lo, max(v) AS hi FROM ({sql.long_form('base', MEASURES)})
            GROUP BY col)) g
LEFT JOIN (SELECT col AS c, v FROM ({sql.long_form('base', MEASURES)})) x
  ON x.c = g.col AND x.v >= lo + bin * w AND (bin = 29 OR x.v < lo + (bin + 1) * w)
GROUP BY ALL""",
    )
)
def histogram_30(spark, sf_dir):
    return profile.histogram(labelled(spark, sf_dir), columns=MEASURES, bins=30)


BOX_COLUMNS = ["custserv_calls", "day_mins", "intl_mins"]


@query(
    sql.statement(
        "base",
        f"""SELECT q.col AS "column", q.class, q.n AS "count", q.q1, q.median, q.q3,
  min(least(v, q1)) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
  max(greatest(v, q3)) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
FROM (SELECT col, CASE churn WHEN 1 THEN 'Churn' ELSE 'Non-churn' END AS class, count(*) AS n,
        quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
      FROM ({sql.long_form('base', BOX_COLUMNS, 'churn')}) GROUP BY 1, 2) q
JOIN ({sql.long_form('base', BOX_COLUMNS, 'churn')}) x
  ON x.col = q.col AND (CASE x.churn WHEN 1 THEN 'Churn' ELSE 'Non-churn' END) = q.class
GROUP BY q.col, q.class, q.n, q.q1, q.median, q.q3""",
    )
)
def boxplot_by_class(spark, sf_dir):
    return profile.box_stats(labelled(spark, sf_dir), columns=BOX_COLUMNS, by=LABEL)


_QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


@query(
    sql.statement(
        "prepared",
        "\nUNION ALL\n".join(
            f"""SELECT '{c}' AS "column", CAST({q} AS DOUBLE) AS quantile, count({c}) AS "values", true AS close
FROM prepared"""
            for c in BOX_COLUMNS
            for q in _QUANTILES
        ),
    )
)
def quantile_sketch_merge(spark, sf_dir):
    """Quantiles from sketches kept per split and merged; close: the rank is off by 1 % at most."""
    rows = prepared(spark, sf_dir)
    kept = scratch_path(spark, "sketches")
    usage_io.write_usage(profile.quantile_sketches(rows, columns=BOX_COLUMNS, by=["split"]), kept)
    merged = profile.merged_sketches(usage_io.read_usage(spark, kept))
    found = profile.sketched_quantiles(merged, quantiles=_QUANTILES)
    values = rows.select(*[F.col(c).cast("double").alias(c) for c in BOX_COLUMNS]).unpivot([], BOX_COLUMNS, "column", "v")
    # One row per column and quantile asked for goes to every task.
    ranks = values.join(F.broadcast(found), "column").groupBy("column", "quantile", "values")
    ranks = ranks.agg(F.avg((F.col("v") < F.col("value")).cast("int")).alias("below"), F.avg((F.col("v") <= F.col("value")).cast("int")).alias("upto"))
    close = (F.col("below") <= F.col("quantile") + 0.01) & (F.col("upto") >= F.col("quantile") - 0.01)
    return ranks.select("column", "quantile", "values", close.alias("close"))


# --- Cleaning ------------------------------------------------------------------------


@query(sql.statement("base", "SELECT * FROM base"))
def clean_base(spark, sf_dir):
    return clean.base(records(spark, sf_dir), drop=[IDENTIFIER], label=LABEL)


@query(sql.statement("base", f"SELECT DISTINCT {sql.MEASURE_LIST}, churn FROM base"))
def clean_dedup(spark, sf_dir):
    return clean.dedup(labelled(spark, sf_dir).drop(KEY), enabled=True)


@query(
    sql.statement(
        "base",
        sql.per_column(
            "base", MEASURES, "round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev"
        ),
    )
)
def zscore_stats(spark, sf_dir):
    found = clean.zscore_stats(labelled(spark, sf_dir), columns=MEASURES)
    return rounded(found, "mean", "stddev")


@query(
    sql.statement(
        "flagged",
        "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c}_flag) AS {c}" for c in MEASURES)
        + " FROM flagged",
    )
)
def zscore_flags(spark, sf_dir):
    found = clean.zscore_flags(labelled(spark, sf_dir), columns=MEASURES)
    return found.agg(*[F.count_if(f"{c}_flag").alias(c) for c in MEASURES])


@query(sql.statement("status", "SELECT account_id, status FROM status"))
def zscore_status(spark, sf_dir):
    return flagged(spark, sf_dir).select(KEY, "status")


@query(sql.statement("clean", "SELECT * FROM clean"))
def clean_rows(spark, sf_dir):
    return clean.clean_rows(flagged(spark, sf_dir))


@query(
    sql.statement(
        "status",
        f"SELECT account_id, {sql.MEASURE_LIST}, churn FROM status WHERE status = 'anomaly'",
    )
)
def anomaly_rows(spark, sf_dir):
    return clean.anomaly_rows(flagged(spark, sf_dir))


@query(
    sql.statement(
        "status",
        """SELECT count(*) AS "rows", count(*) FILTER (WHERE status = 'clean') AS clean,
  count(*) FILTER (WHERE status = 'anomaly') AS anomaly, CAST(0 AS BIGINT) AS unknown,
  round(count(*) FILTER (WHERE status = 'anomaly') / count(*) * 100, 2) AS anomaly_pct
FROM status""",
    )
)
def anomaly_rate(spark, sf_dir):
    return clean.anomaly_rate(flagged(spark, sf_dir))


# --- Features ------------------------------------------------------------------------


@query(
    "WITH " + sql.STEPS["usage"] + "," + sql.STEPS["base"]
    + f" SELECT account_id, {sql.DERIVED_LIST} FROM ({sql.features_sql('base')})"
)
def features_all(spark, sf_dir):
    return features.add_features(labelled(spark, sf_dir)).select(KEY, *DERIVED)


def _credited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage in which service credits make some denominators negative."""
    credit = lambda c: (F.col(c) - F.lit(10)).alias(c)
    changed = {"day_mins", "day_charge"}
    base = labelled(spark, sf_dir)
    return base.select(*[credit(c) if c in changed else c for c in base.columns])


_CREDITED = sql.MEASURE_LIST.replace("day_mins", "day_mins - 10 AS day_mins").replace(
    "day_charge", "day_charge - 10 AS day_charge"
)


@query(
    "WITH " + sql.STEPS["usage"] + "," + sql.STEPS["base"]
    + f", credited AS (SELECT account_id, {_CREDITED} FROM base) SELECT account_id, {sql.DERIVED_LIST} FROM ("
    + sql.features_sql("credited", lambda n, d: f"coalesce({n} / nullif({d}, 0), 0.0)")
    + ")"
)
def features_zero_only(spark, sf_dir):
    found = features.add_features(_credited(spark, sf_dir), zero_only=True)
    return found.select(KEY, *DERIVED)


@query(sql.statement("prepared", sql.per_column("prepared", [*DERIVED, LABEL], _DESCRIBE.replace(
    'CAST(min({c}) AS DOUBLE)', 'round(min({c}), 6)').replace(
    'CAST(max({c}) AS DOUBLE)', 'round(max({c}), 6)'))))
def features_describe(spark, sf_dir):
    found = profile.describe(prepared(spark, sf_dir), columns=[*DERIVED, LABEL])
    return rounded(found, "mean", "stddev", "min", "max")


# --- Splits and leakage --------------------------------------------------------------


@query(
    sql.statement(
        "usage",
        f"SELECT account_id, {sql.split_sql(sql.hash_sql('account_id') + ' % 100')} AS split FROM usage",
    )
)
def split_random(spark, sf_dir):
    return split.random_split(records(spark, sf_dir), key=KEY).select(KEY, "split")


@query(
    sql.statement(
        "clean",
        f"""SELECT account_id, {sql.split_sql(sql.hash_sql('account_id') + ' % 100')} AS split,
  total_mins FROM (SELECT account_id, day_mins + eve_mins + night_mins + intl_mins AS total_mins
                   FROM clean) t""",
    )
)
def split_by_id_join(spark, sf_dir):
    rows = clean.clean_rows(flagged(spark, sf_dir))
    ids = split.random_split(rows.select(KEY), key=KEY)
    return split.split_by_ids(features.add_features(rows), ids, key=KEY).select(
        KEY, "split", "total_mins"
    )


@query(
    sql.statement(
        "base",
        f"""SELECT account_id, CASE WHEN place < n * 70 // 100 THEN 'train'
  WHEN place < n * 85 // 100 THEN 'val' ELSE 'test' END AS split
FROM (SELECT account_id, count(*) OVER (PARTITION BY churn) AS n,
        row_number() OVER (PARTITION BY churn ORDER BY {sql.hash_sql('account_id', 15)}, account_id) - 1 AS place
      FROM base)""",
    )
)
def split_stratified(spark, sf_dir):
    found = split.stratified_split(labelled(spark, sf_dir), key=KEY, label=LABEL)
    return found.select(KEY, "split")


_CONTENT = [*MEASURES, LABEL]


@query(
    sql.statement(
        "base",
        f"""SELECT account_id, {sql.split_sql(sql.hash_sql('h') + ' % 100')} AS split
FROM (SELECT account_id, {sql.fingerprint_sql(_CONTENT)} AS h FROM base)""",
    )
)
def split_content(spark, sf_dir):
    found = split.content_split(labelled(spark, sf_dir), columns=_CONTENT)
    return found.select(KEY, "split")


@query(
    sql.statement(
        "prepared",
        """SELECT split, count(*) AS "rows", round(count(*) / sum(count(*)) OVER (), 6) AS share,
  round(avg(churn), 6) AS positive_rate FROM prepared GROUP BY split""",
    )
)
def split_summary(spark, sf_dir):
    return rounded(
        split.summary(prepared(spark, sf_dir), label=LABEL), "share", "positive_rate"
    )


@query(
    sql.statement(
        "base", f"SELECT account_id, {sql.fingerprint_sql(_CONTENT)} AS row_hash FROM base"
    )
)
def row_hash(spark, sf_dir):
    return split.row_hash(labelled(spark, sf_dir), columns=_CONTENT).select(KEY, "row_hash")


@query(
    sql.statement(
        "base", f"SELECT DISTINCT {sql.fingerprint_sql(_CONTENT)} AS row_hash FROM base"
    )
)
def distinct_row_hashes(spark, sf_dir):
    return split.distinct_contents(labelled(spark, sf_dir), columns=_CONTENT)


@query(
    sql.statement(
        "prepared",
        f"""SELECT p.split_a, p.split_b, count(x.k) AS shared_contents
FROM (VALUES ('train', 'val'), ('train', 'test'), ('val', 'test')) p(split_a, split_b)
LEFT JOIN (SELECT a.split AS sa, b.split AS sb, a.k
           FROM (SELECT DISTINCT split, {sql.fingerprint_sql(_CONTENT)} AS k FROM prepared) a
           JOIN (SELECT DISTINCT split, {sql.fingerprint_sql(_CONTENT)} AS k FROM prepared) b
             ON a.k = b.k AND a.split <> b.split) x
  ON x.sa = p.split_a AND x.sb = p.split_b
GROUP BY 1, 2""",
    )
)
def split_overlap(spark, sf_dir):
    return split.overlap(prepared(spark, sf_dir), columns=_CONTENT)


@query(
    sql.statement(
        "prepared",
        """SELECT c.n AS source_rows, train_rows, val_rows, test_rows,
  train_rows + val_rows + test_rows AS split_rows,
  c.n - (train_rows + val_rows + test_rows) AS difference
FROM (SELECT count(*) AS n FROM clean) c,
  (SELECT count(*) FILTER (WHERE split = 'train') AS train_rows,
     count(*) FILTER (WHERE split = 'val') AS val_rows,
     count(*) FILTER (WHERE split = 'test') AS test_rows FROM prepared) p""",
    )
)
def split_reconcile(spark, sf_dir):
    source = clean.clean_rows(flagged(spark, sf_dir))
    return split.reconcile(source, prepared(spark, sf_dir))


@query(
    sql.statement(
        "prepared",
        """SELECT CAST(row_number() OVER (ORDER BY churn DESC, account_id) AS INT) AS client_id,
  account_id, churn, total_mins
FROM (SELECT *, row_number() OVER (PARTITION BY churn ORDER BY account_id) AS rn
      FROM prepared WHERE split = 'test')
WHERE rn <= CASE churn WHEN 1 THEN 3 ELSE 2 END""",
    )
)
def contrast_sample(spark, sf_dir):
    test = prepared(spark, sf_dir).filter("split = 'test'")
    return split.contrast_sample(
        test.select(KEY, LABEL, "total_mins"), label=LABEL, key=KEY
    )


@query(
    sql.statement(
        "prepared",
        "\nUNION ALL\n".join(
            [
                "SELECT 'records' AS dataset, 'phone_number' AS \"column\","
                ' count(phone_number) AS "values" FROM usage'
            ]
            + [
                f"SELECT 'features' AS dataset, '{c}' AS \"column\", count({c}) AS \"values\""
                " FROM prepared"
                for c in [*DERIVED, "split"]
            ]
        ),
    )
)
def schema_diff(spark, sf_dir):
    return checks.schema_diff(
        {"records": records(spark, sf_dir), "features": prepared(spark, sf_dir)}
    )


_TYPES = {"int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


@query(
    sql.statement("usage", "").rstrip()
    + ", "
    + sql.STEPS["base"].strip()
    + """, credited AS (SELECT *, day_mins / 2 AS half_mins FROM base)
SELECT dataset, "column", CASE kind """
    + " ".join(f"WHEN '{theirs}' THEN '{ours}'" for ours, theirs in _TYPES.items())
    + """ ELSE lower(kind) END AS "type" FROM (
  SELECT 'base' AS dataset, column_name AS "column", column_type AS kind FROM (DESCRIBE SELECT phone_number FROM usage)
  UNION ALL SELECT 'credited', column_name, column_type FROM (DESCRIBE SELECT half_mins FROM credited))"""
)
def column_diff(spark, sf_dir):
    """Names and types only; neither table is read for it."""
    rows = records(spark, sf_dir)
    halves = labelled(spark, sf_dir).withColumn("half_mins", F.col("day_mins") / 2)
    return checks.column_diff({"base": rows, "credited": halves})


# --- Scaling -------------------------------------------------------------------------


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir).filter("split = 'train'")


def _test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir).filter("split = 'test'")


@query(
    sql.statement(
        "prepared",
        sql.per_column(
            "prepared WHERE split = 'train'",
            MEASURES,
            "round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev",
        ),
    )
)
def scaler_params(spark, sf_dir):
    train = _train(spark, sf_dir)
    model = models.fit_scaler(train, columns=MEASURES)
    return rounded(models.fitted_scaler_params(train, model), "mean", "stddev")


@query(
    sql.statement(
        "prepared",
        sql.per_column(
            "prepared WHERE split = 'train'",
            MEASURES,
            "round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS stddev",
        ),
    )
)
def scaler_params_pop(spark, sf_dir):
    found = models.scaler_params(_train(spark, sf_dir), columns=MEASURES, population=True)
    return rounded(found, "mean", "stddev")


@query(
    sql.statement(
        "prepared",
        "SELECT account_id, split, "
        + ", ".join(
            f"round((p.{c} - t.m_{c}) / t.s_{c}, 6) AS {c}_scaled" for c in MEASURES
        )
        + " FROM prepared p, (SELECT "
        + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in MEASURES)
        + " FROM prepared WHERE split = 'train') t",
    )
)
def scaled_columns(spark, sf_dir):
    rows = prepared(spark, sf_dir)
    model = models.fit_scaler(rows.filter("split = 'train'"), columns=MEASURES)
    scaled = [f"{c}_scaled" for c in MEASURES]
    return rounded(models.scaled_columns(rows, model).select(KEY, "split", *scaled), *scaled)


# --- Weights and models --------------------------------------------------------------


@query(
    sql.statement(
        "prepared",
        """SELECT neg AS negatives, pos AS positives, round(neg / pos * 0.4, 9) AS pos_weight,
  round((neg + pos) / (2 * neg), 9) AS negative_weight,
  round((neg + pos) / (2 * pos), 9) AS positive_weight
FROM (SELECT count(*) FILTER (WHERE churn = 0) AS neg, count(*) FILTER (WHERE churn = 1) AS pos
      FROM prepared WHERE split = 'train')""",
    )
)
def class_weights(spark, sf_dir):
    found = models.class_weights(_train(spark, sf_dir), label=LABEL)
    return rounded(found, "pos_weight", "negative_weight", "positive_weight", digits=9)


@query(
    sql.statement(
        "prepared",
        f"""SELECT account_id, churn, CAST(unnest(range(1, n + 1)) AS INT) AS "copy"
FROM (SELECT account_id, churn, CASE churn WHEN 0 THEN 1 ELSE CAST(floor(w) AS INT) + CAST(
        {sql.hash_sql('account_id')} / 4294967296 < w - floor(w) AS INT) END AS n
      FROM (SELECT * FROM prepared WHERE split = 'train') p,
        (SELECT count(*) FILTER (WHERE churn = 0) / count(*) FILTER (WHERE churn = 1)
           * CAST(0.4 AS DOUBLE) AS w FROM prepared WHERE split = 'train') t)""",
    )
)
def weighted_resample(spark, sf_dir):
    found = models.weighted_resample(_train(spark, sf_dir), label=LABEL, key=KEY)
    return found.select(KEY, LABEL, "copy")


_FITTED: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, fit: Callable):
    """What ``fit`` returns for the train and validation rows, once per application and state of the source."""
    place = (spark.sparkContext.applicationId, sf_dir, source_state(spark, sf_dir), name)
    if place not in _FITTED:
        rows = prepared(spark, sf_dir)
        _FITTED[place] = fit(rows.filter("split = 'train'"), rows.filter("split = 'val'"))
    return _FITTED[place]


def fitted_mlp(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, DataFrame]:
    """The network and its history."""
    fit = lambda train, val: models.fit_mlp(train, val, columns=FEATURES)
    return _once(spark, sf_dir, "mlp", fit)


def fitted_forest(spark: SparkSession, sf_dir: str) -> PipelineModel:
    fit = lambda train, _: models.fit_forest(train, columns=FEATURES)
    return _once(spark, sf_dir, "forest", fit)


def model_scores(
    spark: SparkSession, sf_dir: str, name: str, model: PipelineModel
) -> DataFrame:
    """Test rows with a model's probability as ``p``, scored once and stored."""
    build = lambda: score.positive_score(_test(spark, sf_dir), model, "p").select(KEY, LABEL, "p")
    return written(spark, sf_dir, f"{name}-scores-{model.uid}", build)


def _fit_figures(scored: DataFrame, size: int) -> DataFrame:
    p = F.col("p")
    area = evaluate.roc_auc(scored, label=LABEL, score="p").scalar()
    return scored.agg(
        F.count("*").alias("rows"),
        F.lit(size).alias("size"),
        F.min(p.isNotNull() & p.between(0, 1)).alias("probabilities"),
    ).withColumn("ranks_well", area >= 0.9)


@query(
    sql.statement(
        "prepared",
        """SELECT count(*) AS "rows", 13474 AS size, true AS probabilities, true AS ranks_well
FROM prepared WHERE split = 'test'""",
    )
)
def mlp_fit_score(spark, sf_dir):
    mlp, _ = fitted_mlp(spark, sf_dir)
    scored = model_scores(spark, sf_dir, "mlp", mlp)
    return _fit_figures(scored, models.parameter_count(mlp))


@query(
    sql.statement(
        "prepared",
        """SELECT count(*) AS "rows", 100 AS size, true AS probabilities, true AS ranks_well
FROM prepared WHERE split = 'test'""",
    )
)
def rf_fit_score(spark, sf_dir):
    forest = fitted_forest(spark, sf_dir)
    scored = model_scores(spark, sf_dir, "forest", forest)
    return _fit_figures(scored, forest.stages[-1].getNumTrees)


@query(
    sql.statement(
        "prepared",
        """SELECT count(*) FILTER (WHERE split = 'train') AS train_rows,
  count(*) FILTER (WHERE split = 'val') AS val_rows, true AS rounds_in_order, true AS ended_by_rule,
  true AS best_is_kept, true AS losses_hold, true AS f1_hold FROM prepared WHERE split <> 'test'""",
    )
)
def mlp_early_stop_history(spark, sf_dir):
    mlp, history = fitted_mlp(spark, sf_dir)
    rows = prepared(spark, sf_dir)
    weight = (
        models.class_weights(rows.filter("split = 'train'"), label=LABEL)
        .select("pos_weight")
        .scalar()
    )
    # Every figure of the best round, measured anew on the model that was kept.
    measured = score.positive_score(rows.filter("split != 'test'"), mlp, "p")
    loss = evaluate.row_loss(F.col(LABEL), F.col("p"), weight)
    best = history.orderBy("val_loss", "round").first()
    last = history.agg(F.max("round").alias("last"), F.count("*").alias("n")).first()
    stale = last["last"] - best["round"]
    ended = stale == models.PATIENCE or (last["n"] == models.ROUNDS and stale < models.PATIENCE)
    y, guess = F.col(LABEL), decide(F.col("p"))
    of = lambda part, value: F.when(F.col("split") == part, value)
    f1 = lambda part: F.try_divide(2 * F.sum(of(part, y * guess)), F.sum(of(part, y)) + F.sum(of(part, guess)))
    near = lambda figure, name: F.abs(figure - F.lit(best[name])) < 1e-6
    figures = measured.agg(
        *[F.count(of(part, 1)).alias(f"{part}_rows") for part in ("train", "val")],
        *[F.avg(of(part, loss)).alias(f"{part}_loss") for part in ("train", "val")],
        *[F.coalesce(f1(part), F.lit(0.0)).alias(f"{part}_f1") for part in ("train", "val")],
    )
    c = F.col
    return figures.select(
        "train_rows",
        "val_rows",
        F.lit(last["last"] == last["n"]).alias("rounds_in_order"),
        F.lit(ended).alias("ended_by_rule"),
        near(c("val_loss"), "val_loss").alias("best_is_kept"),
        (near(c("train_loss"), "train_loss") & near(c("val_loss"), "val_loss")).alias("losses_hold"),
        (near(c("train_f1"), "train_f1") & near(c("val_f1"), "val_f1")).alias("f1_hold"),
    )


@query(
    sql.statement(
        "prepared",
        """SELECT count(*) AS "rows", 4 AS rounds, true AS same_history, true AS same_scores FROM prepared
WHERE split = 'test'""",
    )
)
def mlp_resumed_fit(spark, sf_dir):
    """A fit that ended after two rounds and was resumed, beside one that ran through."""
    train, val = _train(spark, sf_dir), prepared(spark, sf_dir).filter("split = 'val'")
    small = {"columns": FEATURES, "hidden": (8,), "iterations": 3, "patience": 4}
    whole, history = models.fit_mlp(train, val, rounds=4, **small)
    path = scratch_path(spark, "training")
    models.fit_mlp(train, val, rounds=2, save_best=path, **small)
    resumed, again = models.fit_mlp(train, val, rounds=4, save_best=path, resume=True, **small)
    figures = [c for c in history.columns if c != "round"]
    paired = history.join(again.withColumnsRenamed({c: f"{c}_again" for c in figures}), "round", "full")
    near = lambda a, b: F.coalesce(F.abs(F.col(a) - F.col(b)) < 1e-6, F.lit(False))
    rounds = paired.agg(F.count("*").alias("n"), F.min(any_of([~near(c, f"{c}_again") for c in figures]) == F.lit(False)).alias("same")).first()
    scored = score.positive_score(score.positive_score(_test(spark, sf_dir), whole, "p"), resumed, "p_again")
    return scored.agg(
        F.count("*").alias("rows"),
        F.lit(rounds["n"]).cast("int").alias("rounds"),
        F.lit(rounds["same"]).alias("same_history"),
        F.min(near("p", "p_again")).alias("same_scores"),
    )


@query(
    sql.statement(
        "prepared",
        """SELECT count(*) AS "rows", CAST(0 AS BIGINT) AS different FROM prepared
WHERE split = 'test'""",
    )
)
def model_save_load_same_scores(spark, sf_dir):
    mlp, forest = fitted_mlp(spark, sf_dir)[0], fitted_forest(spark, sf_dir)
    copies = []
    for model in (mlp, forest):
        path = scratch_path(spark, "model")
        usage_io.save_model(model, path)
        copies.append(usage_io.load_model(path))
    scored = score.score_both(_test(spark, sf_dir), mlp, forest)
    scored = score.positive_score(scored, copies[0], "mlp_again")
    scored = score.positive_score(scored, copies[1], "rf_again")
    differs = (F.col("mlp_prob") != F.col("mlp_again")) | (F.col("rf_prob") != F.col("rf_again"))
    return scored.agg(F.count("*").alias("rows"), F.count_if(differs).alias("different"))


@query(
    sql.statement(
        "prepared",
        """SELECT count(*) AS "rows", true AS probabilities, true AS is_mean, true AS tiered
FROM prepared WHERE split = 'test'""",
    )
)
def score_ensemble(spark, sf_dir):
    mlp, forest = fitted_mlp(spark, sf_dir)[0], fitted_forest(spark, sf_dir)
    scored = score.score_both(_test(spark, sf_dir), mlp, forest)
    table = score.score_table(
        score.ensemble(scored, scores=["mlp_prob", "rf_prob"]), score="ensemble_prob"
    )
    p = F.col("ensemble_prob")
    # Told again in SQL, apart from the functions that made the columns.
    again = """CASE WHEN ensemble_prob < 0.25 THEN 'low' WHEN ensemble_prob < 0.45 THEN 'moderate'
      WHEN ensemble_prob < 0.65 THEN 'high' ELSE 'critical' END = risk_level
      AND CASE WHEN ensemble_prob >= 0.4 THEN 1 ELSE 0 END = predicted"""
    between = p.between(F.least("mlp_prob", "rf_prob"), F.greatest("mlp_prob", "rf_prob"))
    return table.agg(
        F.count("*").alias("rows"),
        F.min(p.between(0, 1)).alias("probabilities"),
        ((F.abs(F.avg(p) - F.avg(F.expr("mlp_prob / 2 + rf_prob / 2"))) < 1e-12) & F.min(between)).alias("is_mean"),
        F.min(F.coalesce(F.expr(again), F.lit(False))).alias("tiered"),
    )


@query(
    sql.statement(
        "prepared",
        """SELECT least(count(*), 32) AS "rows", min(account_id) AS first_account,
  true AS probabilities
FROM (SELECT account_id FROM prepared WHERE split = 'test' ORDER BY account_id LIMIT 32)""",
    )
)
def score_batch_32(spark, sf_dir):
    mlp, _ = fitted_mlp(spark, sf_dir)
    batch = split.first_rows(_test(spark, sf_dir), key=KEY, n=32)
    scored = score.positive_score(batch, mlp, "p")
    return scored.agg(
        F.count("*").alias("rows"),
        F.min(KEY).alias("first_account"),
        F.min(F.col("p").between(0, 1)).alias("probabilities"),
    )


# --- Evaluation on scores both engines can compute -----------------------------------


def with_proxy_scores(df: DataFrame) -> DataFrame:
    """Two logistic scores with fixed coefficients, to six decimals."""
    calls, minutes = F.col("custserv_calls"), F.col("day_mins")
    return df.withColumns(
        {
            "score": F.round(sigmoid(F.lit(0.9) * calls + F.lit(0.03) * minutes - 3.0), 6),
            "score_b": F.round(sigmoid(F.lit(0.6) * calls + F.lit(0.05) * minutes - 3.5), 6),
        }
    )


def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_proxy_scores(prepared(spark, sf_dir))


def _scored_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_rows(spark, sf_dir).filter("split = 'test'")


SCORE_DIGITS = 6
_TEST = "scored WHERE split = 'test'"
_CASES = """count(*) FILTER (WHERE churn = 0 AND {s} < {t}) AS tn,
  count(*) FILTER (WHERE churn = 0 AND {s} >= {t}) AS fp,
  count(*) FILTER (WHERE churn = 1 AND {s} < {t}) AS fn,
  count(*) FILTER (WHERE churn = 1 AND {s} >= {t}) AS tp"""
_F1 = "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0)"
_AUC = """(sum(r) FILTER (WHERE churn = 1) - count(*) FILTER (WHERE churn = 1)
    * (count(*) FILTER (WHERE churn = 1) + 1) / 2)
  / (count(*) FILTER (WHERE churn = 1) * CAST(count(*) FILTER (WHERE churn = 0) AS DOUBLE))"""


def _ranked(source: str, value: str) -> str:
    """Average rank of ``value``, equal values sharing theirs."""
    return f"""(SELECT churn, rank() OVER (ORDER BY {value})
    + (count(*) OVER (PARTITION BY {value}) - 1) / 2 AS r FROM {source})"""


@query(sql.statement("scored", "SELECT account_id, score, score_b FROM scored"))
def score_proxy(spark, sf_dir):
    return scored_rows(spark, sf_dir).select(KEY, "score", "score_b")


@query(
    sql.statement("scored", f"SELECT {_CASES.format(s='score', t='0.4')} FROM {_TEST}")
)
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion(_scored_test(spark, sf_dir), label=LABEL, score="score")


@query(
    sql.statement(
        "scored",
        f"""SELECT CAST(0.4 AS DOUBLE) AS threshold,
  round((tn + tp) / (tn + fp + fn + tp), 6) AS accuracy, round({_F1}, 6) AS f1
FROM (SELECT {_CASES.format(s='score', t='0.4')} FROM {_TEST})""",
    )
)
def binary_metrics(spark, sf_dir):
    found = evaluate.binary_metrics(_scored_test(spark, sf_dir), label=LABEL, score="score")
    return rounded(found, "accuracy", "f1")


_ROC_AUC = sql.statement(
    "scored", f"SELECT round({_AUC}, 6) AS auc FROM {_ranked(_TEST, 'score')}"
)


@query(_ROC_AUC)
def roc_auc(spark, sf_dir):
    found = evaluate.roc_auc(
        _scored_test(spark, sf_dir), label=LABEL, score="score", digits=SCORE_DIGITS
    )
    return rounded(found, "auc")


@query(_ROC_AUC)
def roc_auc_any_score(spark, sf_dir):
    found = evaluate.roc_auc(_scored_test(spark, sf_dir), label=LABEL, score="score")
    return rounded(found, "auc")


_POINTS = f"""SELECT score AS threshold, neg, pos,
    sum(neg) OVER w / sum(neg) OVER () AS fpr, sum(pos) OVER w / sum(pos) OVER () AS tpr,
    row_number() OVER w AS place, count(*) OVER () AS n,
    lead(neg) OVER w AS next_neg, lead(pos) OVER w AS next_pos
  FROM (SELECT score, count(*) FILTER (WHERE churn = 0) AS neg,
          count(*) FILTER (WHERE churn = 1) AS pos FROM {_TEST} GROUP BY score)
  WINDOW w AS (ORDER BY score DESC)"""


@query(
    sql.statement("scored", f"SELECT threshold, {rounded_sql('fpr', 'tpr')} FROM ({_POINTS})")
)
def roc_points(spark, sf_dir):
    found = evaluate.roc_points(
        _scored_test(spark, sf_dir), label=LABEL, score="score", digits=SCORE_DIGITS
    )
    return rounded(found, "fpr", "tpr")


@query(
    sql.statement(
        "scored",
        f"""SELECT threshold, {rounded_sql('fpr', 'tpr')} FROM ({_POINTS})
WHERE place = 1 OR place = n OR neg <> next_neg OR pos <> next_pos
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""",
    )
)
def roc_curve(spark, sf_dir):
    found = evaluate.roc_points(
        _scored_test(spark, sf_dir),
        label=LABEL,
        score="score",
        digits=SCORE_DIGITS,
        drop_collinear=True,
    )
    return rounded(found, "fpr", "tpr")


@query(
    sql.statement(
        "scored",
        f"""SELECT v.class, round(v.p, 6) AS precision, round(v.r, 6) AS recall, round(v.f, 6) AS f1,
  v.s AS support
FROM (SELECT *, tn / (tn + fn) AS np, tn / (tn + fp) AS nr, 2 * tn / (2 * tn + fn + fp) AS nf,
        tp / (tp + fp) AS pp, tp / (tp + fn) AS pr, 2 * tp / (2 * tp + fn + fp) AS pf,
        tn + fp AS ns, fn + tp AS ps, tn + fp + fn + tp AS al
      FROM (SELECT {_CASES.format(s='score', t='0.4')} FROM {_TEST})) c,
LATERAL (VALUES ('Non-churn', np, nr, nf, ns), ('Churn', pp, pr, pf, ps),
  ('accuracy', (tn + tp) / al, (tn + tp) / al, (tn + tp) / al, al),
  ('macro avg', (np + pp) / 2, (nr + pr) / 2, (nf + pf) / 2, al),
  ('weighted avg', (np * ns + pp * ps) / al, (nr * ns + pr * ps) / al,
    (nf * ns + pf * ps) / al, al)) v(class, p, r, f, s)""",
    )
)
def classification_report(spark, sf_dir):
    found = evaluate.report(_scored_test(spark, sf_dir), label=LABEL, score="score")
    return rounded(found, "precision", "recall", "f1")


def _sweep_sql(split_name: str) -> str:
    return f"""SELECT threshold, tn, fp, fn, tp, {_F1} AS f1
FROM (SELECT g.t AS threshold, {_CASES.format(s='score', t='g.t')}
      FROM (SELECT score, churn FROM scored WHERE split = '{split_name}') s,
        (SELECT CAST(round(0.1 + 0.05 * i, 2) AS DOUBLE) AS t FROM range(16) x(i)) g
      GROUP BY g.t)"""


@query(
    sql.statement(
        "scored",
        f"SELECT threshold, tn, fp, fn, tp, round(f1, 6) AS f1 FROM ({_sweep_sql('val')})",
    )
)
def threshold_sweep(spark, sf_dir):
    val = scored_rows(spark, sf_dir).filter("split = 'val'")
    return rounded(evaluate.threshold_sweep(val, label=LABEL, score="score"), "f1")


@query(
    sql.statement(
        "scored",
        f"""SELECT b.threshold, round(b.f1, 6) AS val_f1, round({_F1}, 6) AS test_f1
FROM (SELECT threshold, f1 FROM ({_sweep_sql('val')}) ORDER BY f1 DESC, threshold LIMIT 1) b
JOIN ({_sweep_sql('test')}) t ON t.threshold = b.threshold""",
    )
)
def best_threshold(spark, sf_dir):
    """Chosen on validation rows, measured on test rows."""
    rows = scored_rows(spark, sf_dir)
    sweep = lambda s: evaluate.threshold_sweep(
        rows.filter(F.col("split") == s), label=LABEL, score="score"
    )
    best = evaluate.best_threshold(sweep("val")).withColumnRenamed("f1", "val_f1")
    test = sweep("test").select("threshold", F.col("f1").alias("test_f1"))
    return rounded(best.join(test, "threshold"), "val_f1", "test_f1")


@query(
    sql.statement(
        "scored",
        "\nUNION ALL\n".join(
            f"""SELECT '{name}' AS model, CAST({t} AS DOUBLE) AS threshold,
  (SELECT round({_F1}, 6) FROM (SELECT {_CASES.format(s=s, t=t)} FROM {_TEST})) AS f1,
  (SELECT round({_AUC}, 6) FROM {_ranked(_TEST, s)}) AS auc"""
            for name, s, t in (("network", "score", 0.4), ("forest", "score_b", 0.5))
        ),
    )
)
def model_comparison(spark, sf_dir):
    test = _scored_test(spark, sf_dir)
    long = test.withColumnsRenamed({"score": "network", "score_b": "forest"}).unpivot(
        [LABEL], ["network", "forest"], "model", "score"
    )
    found = evaluate.compare(
        long,
        model="model",
        label=LABEL,
        score="score",
        thresholds={"network": 0.4, "forest": FOREST_THRESHOLD},
        digits=SCORE_DIGITS,
    )
    return rounded(found, "f1", "auc")


@query(
    sql.statement(
        "scored",
        f"""SELECT round((tn + tp) / (tn + fp + fn + tp), 4) AS accuracy, round({_F1}, 4) AS f1_score,
  (SELECT round({_AUC}, 4) FROM {_ranked(_TEST, 'score')}) AS auc_roc
FROM (SELECT {_CASES.format(s='score', t='0.4')} FROM {_TEST})""",
    )
)
def metrics_row(spark, sf_dir):
    return evaluate.metrics_row(
        _scored_test(spark, sf_dir), label=LABEL, score="score", digits=SCORE_DIGITS
    )


@query(
    sql.statement(
        "scored",
        """SELECT round(avg(-(CASE churn WHEN 1 THEN w * ln(p) ELSE ln(1 - p) END)), 6) AS log_loss
FROM (SELECT churn, least(greatest(score, 1e-15), 1 - 1e-15) AS p FROM scored
      WHERE split = 'val') s,
  (SELECT count(*) FILTER (WHERE churn = 0) / count(*) FILTER (WHERE churn = 1) * 0.4 AS w
   FROM scored WHERE split = 'train') t""",
    )
)
def weighted_log_loss(spark, sf_dir):
    rows = scored_rows(spark, sf_dir)
    weight = (
        models.class_weights(rows.filter("split = 'train'"), label=LABEL)
        .select("pos_weight")
        .scalar()
    )
    val = rows.filter("split = 'val'")
    found = evaluate.log_loss(val, label=LABEL, score="score", pos_weight=weight)
    return rounded(found, "log_loss")


# --- Scoring -------------------------------------------------------------------------


@query(
    sql.statement(
        "scored",
        f"""SELECT account_id, {sql.as_spark_rounds('score', 4)} AS score,
  {sql.as_spark_rounds('score_b', 4)} AS score_b,
  {sql.as_spark_rounds('(score + score_b) / 2', 4)} AS ensemble_prob FROM scored""",
    )
)
def ensemble_proxy(spark, sf_dir):
    both = ["score", "score_b"]
    mixed = score.ensemble(scored_rows(spark, sf_dir).select(KEY, *both), scores=both)
    return score.round_scores(mixed, scores=[*both, "ensemble_prob"])


def _tiers(texts: tuple[str, ...]) -> str:
    low, moderate, high, critical = texts
    return (
        f"CASE WHEN score < 0.25 THEN '{low}' WHEN score < 0.45 THEN '{moderate}'"
        f" WHEN score < 0.65 THEN '{high}' ELSE '{critical}' END"
    )


_TIER = _tiers(("low", "moderate", "high", "critical"))


@query(
    sql.statement(
        "scored",
        f"""SELECT account_id, score, {_TIER} AS risk_level,
  {_tiers(("No action needed", "Watch: monthly follow-up", "Targeted retention offer",
           "Priority contact: urgent personal offer"))} AS action,
  CAST(score >= 0.4 AS INT) AS predicted FROM scored""",
    )
)
def risk_tiers(spark, sf_dir):
    found = score.score_table(scored_rows(spark, sf_dir), score="score")
    return found.select(KEY, "score", "risk_level", "action", "predicted")


@query(
    sql.statement(
        "scored",
        f"""SELECT account_id,
  {_tiers(("🟢 Faible", "🟡 Modéré", "🟠 Élevé", "🔴 Critique"))} AS risk_level,
  {_tiers(("Aucune action requise", "Surveillance — suivi mensuel", "Offre de rétention ciblée",
           "Contact prioritaire — offre personnalisée urgente"))} AS action FROM scored""",
    )
)
def risk_tiers_french(spark, sf_dir):
    found = score.score_table(scored_rows(spark, sf_dir), score="score", wording="fr")
    return found.select(KEY, "risk_level", "action")


@query(
    sql.statement(
        "scored",
        f"""SELECT {_TIER} AS risk_level, count(*) AS accounts,
  CAST(sum(CAST(score >= 0.4 AS INT)) AS BIGINT) AS predicted,
  count(*) FILTER (WHERE score >= 0.45) AS at_risk, round(avg(churn), 6) AS churn_rate
FROM scored GROUP BY 1""",
    )
)
def risk_summary(spark, sf_dir):
    found = score.risk_summary(scored_rows(spark, sf_dir), score="score", label=LABEL)
    return rounded(found, "churn_rate")


@query(
    sql.statement(
        "scored",
        f"""SELECT account_id, score, CAST(score >= 0.4 AS INT) AS predicted,
  CASE churn WHEN 1 THEN 'Churn' ELSE 'Non-churn' END AS actual FROM {_TEST}""",
    )
)
def score_vs_actual(spark, sf_dir):
    found = score.score_table(_scored_test(spark, sf_dir), score="score", label=LABEL)
    return found.select(KEY, "score", "predicted", "actual")


# --- Checks --------------------------------------------------------------------------


def _checks_sql(source: str = "prepared") -> str:
    """All checks of each expected split; a split without rows has no figures and fails."""
    varies = [*checks.POSITIVE_MEAN, "total_mins"]
    entry = lambda name, value, bound, passed: (
        f"('{name}', CAST({value} AS DOUBLE), '{bound}', coalesce({passed}, false))"
    )
    entries = [
        entry("rows", "coalesce(n, 0)", ">= 1000", "n >= 1000"),
        entry("feature_nulls", "nulls", "= 0", "nulls = 0"),
        entry("labels_not_0_or_1", "bad", "= 0", "bad = 0"),
        entry("positive_rate", "round(rate, 6)", "0.05 to 0.30", "rate BETWEEN 0.05 AND 0.30"),
        entry("infinite_ratios", "inf", "= 0", "inf = 0"),
        *[
            entry(f"{c}_varies", f"round(s_{c}, 6)", "> 0, no null", f"s_{c} > 0 AND n_{c} = n")
            for c in varies
        ],
        *[
            entry(f"{c}_mean", f"round(m_{c}, 6)", "> 0", f"m_{c} > 0")
            for c in checks.POSITIVE_MEAN
        ],
    ]
    number = lambda c: f"CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END"
    ratios = " + ".join(f"CAST(isinf({c}) AS INT)" for c in DERIVED[3:])
    per_split = f"""SELECT split, count(*) AS n,
    {' + '.join(f'(count(*) - count({number(c)}))' for c in FEATURES)} AS nulls,
    count(*) FILTER (WHERE churn IS NULL OR churn NOT IN (0, 1)) AS bad, avg(churn) AS rate,
    sum({ratios}) AS inf,
    {', '.join(f'stddev_samp({number(c)}) AS s_{c}, avg({number(c)}) AS m_{c}, count({number(c)}) AS n_{c}' for c in varies)}
  FROM {source} GROUP BY split"""
    sizes = f"""SELECT count(*) FILTER (WHERE split = 'train') AS tr,
    count(*) FILTER (WHERE split = 'val') AS va, count(*) FILTER (WHERE split = 'test') AS te
  FROM {source}"""
    return f"""SELECT v."check", g.split AS dataset, v.observed, v.bound, v.passed
FROM (VALUES ('train'), ('val'), ('test')) g(split) LEFT JOIN ({per_split}) p ON p.split = g.split,
LATERAL (VALUES {', '.join(entries)}) v("check", observed, bound, passed)
UNION ALL
SELECT v."check", 'all', v.observed, v.bound, v.passed FROM ({sizes}) p,
LATERAL (VALUES {', '.join([
    entry('train_minus_val', 'tr - va', '> 0', 'tr > va AND va > 0'),
    entry('train_minus_test', 'tr - te', '> 0', 'tr > te AND te > 0'),
    entry('train_share', 'round(tr / (tr + va + te), 6)', '0.60 to 0.80',
          'tr / (tr + va + te) BETWEEN 0.6 AND 0.8'),
    entry('features_present', '23', '= 23', 'true'),
    entry('features_numeric', '23', '= 23', 'true'),
    entry('label_present', '1', '= 1', 'true'),
])}) v("check", observed, bound, passed)"""


@query(sql.statement("prepared", _checks_sql()))
def dq_checks(spark, sf_dir):
    return checks.run_checks(prepared(spark, sf_dir))


_FAULTY = """
faulty AS (
  SELECT * REPLACE (CASE WHEN split = 'test' AND account_id % 7 = 0 THEN 'nan'::DOUBLE ELSE day_mins END AS day_mins)
  FROM prepared WHERE split <> 'val')"""


@query(sql.statement("prepared", "").rstrip() + "," + _FAULTY + "\n" + _checks_sql("faulty"))
def dq_checks_faulty(spark, sf_dir):
    """The checks on a table that lacks its validation rows and has NaN among its test rows."""
    bad = (F.col("split") == "test") & (F.col(KEY) % 7 == 0)
    rows = prepared(spark, sf_dir).where("split <> 'val'")
    return checks.run_checks(rows.withColumn("day_mins", F.when(bad, F.lit(float("nan"))).otherwise(F.col("day_mins"))))


@query(
    sql.statement(
        "scored",
        "\nUNION ALL\n".join(
            f"""SELECT 'not_a_probability' AS "check", '{s}' AS dataset,
  CAST(count(*) FILTER (WHERE {s} IS NULL OR {s} < 0 OR {s} > 1) AS DOUBLE) AS observed,
  '= 0' AS bound, count(*) FILTER (WHERE {s} IS NULL OR {s} < 0 OR {s} > 1) = 0 AS passed
FROM scored"""
            for s in ("score", "score_b")
        ),
    )
)
def score_checks(spark, sf_dir):
    return checks.score_checks(scored_rows(spark, sf_dir), scores=["score", "score_b"])


# --- Records with gaps: nothing is filled in where a join finds no partner ------------

_HOLED = [c for c in MEASURES if c != "account_length"]


@query(
    sql.gaps_statement(
        sql.per_column("gaps", [KEY, *MEASURES, LABEL], "CAST(count(*) - count({c}) AS BIGINT) AS nulls")
    )
)
def profile_nulls_gaps(spark, sf_dir):
    return profile.nulls(incomplete(spark, sf_dir))


_GAP_STATS = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in MEASURES)
_GAP_EXTREME = " OR ".join(
    f"coalesce(abs((g.{c} - t.m_{c}) / nullif(t.s_{c}, 0)) > 6, false)" for c in MEASURES
)
_GAP_STATUS = f"""
gap_status AS (
  SELECT g.account_id, CASE WHEN {_GAP_EXTREME} THEN 'anomaly'
      WHEN {' OR '.join(f'g.{c} IS NULL' for c in MEASURES)} THEN 'unknown' ELSE 'clean' END AS status
  FROM gaps g, (SELECT {_GAP_STATS} FROM gaps) t)"""


@query(sql.gaps_statement("SELECT account_id, status FROM gap_status", _GAP_STATUS))
def zscore_status_gaps(spark, sf_dir):
    return clean.zscore_status(incomplete(spark, sf_dir), columns=MEASURES).select(KEY, "status")


@query(
    sql.gaps_statement(
        """SELECT count(*) AS "rows", count(*) FILTER (WHERE status = 'clean') AS clean,
  count(*) FILTER (WHERE status = 'anomaly') AS anomaly,
  count(*) FILTER (WHERE status = 'unknown') AS unknown,
  round(count(*) FILTER (WHERE status = 'anomaly') / count(*) * 100, 2) AS anomaly_pct
FROM gap_status""",
        _GAP_STATUS,
    )
)
def anomaly_rate_gaps(spark, sf_dir):
    return clean.anomaly_rate(clean.zscore_status(incomplete(spark, sf_dir), columns=MEASURES))


_ZERO_FILLED = f"""
filled AS (
  SELECT account_id, {', '.join(f'coalesce({c}, 0) AS {c}' for c in MEASURES)}, churn FROM gaps)"""


@query(
    sql.gaps_statement(
        f"SELECT account_id, {sql.DERIVED_LIST} FROM ("
        + sql.features_sql("filled", lambda n, d: f"coalesce({n} / nullif({d}, 0), 0.0)")
        + ")",
        _ZERO_FILLED,
    )
)
def features_zero_filled_gaps(spark, sf_dir):
    filled = clean.fill_zero(incomplete(spark, sf_dir), columns=MEASURES)
    return features.add_features(filled, zero_only=True).select(KEY, *DERIVED)


@query(
    sql.gaps_statement(
        f"""SELECT col AS "column", CAST(bin AS INT) AS bin, lo + bin * w AS bin_start,
  CAST(count(v) AS BIGINT) AS "count"
FROM (SELECT col, lo, hi, (hi - lo) / 30 AS w, unnest(range(30)) AS bin
      FROM (SELECT col, min(v) AS lo, max(v) AS hi FROM ({sql.long_form('gaps', MEASURES)})
            GROUP BY col)) g
LEFT JOIN (SELECT col AS c, v FROM ({sql.long_form('gaps', MEASURES)})) x
  ON x.c = g.col AND x.v >= lo + bin * w AND (bin = 29 OR x.v < lo + (bin + 1) * w)
GROUP BY ALL"""
    )
)
def histogram_30_gaps(spark, sf_dir):
    return profile.histogram(incomplete(spark, sf_dir), columns=MEASURES, bins=30)


@query(
    sql.gaps_statement(
        f"""SELECT q.col AS "column", q.class, q.n AS "count", q.q1, q.median, q.q3,
  min(least(v, q1)) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
  max(greatest(v, q3)) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
FROM (SELECT col, CASE churn WHEN 1 THEN 'Churn' ELSE 'Non-churn' END AS class, count(v) AS n,
        quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
      FROM ({sql.long_form('gaps', BOX_COLUMNS, 'churn')}) GROUP BY 1, 2) q
JOIN ({sql.long_form('gaps', BOX_COLUMNS, 'churn')}) x
  ON x.col = q.col AND (CASE x.churn WHEN 1 THEN 'Churn' ELSE 'Non-churn' END) = q.class
GROUP BY q.col, q.class, q.n, q.q1, q.median, q.q3"""
    )
)
def boxplot_by_class_gaps(spark, sf_dir):
    return profile.box_stats(incomplete(spark, sf_dir), columns=BOX_COLUMNS, by=LABEL)


@query(
    sql.gaps_statement(f"SELECT account_id, {sql.fingerprint_sql(_CONTENT)} AS row_hash FROM gaps")
)
def row_hash_gaps(spark, sf_dir):
    return split.row_hash(incomplete(spark, sf_dir), columns=_CONTENT).select(KEY, "row_hash")


@query(
    sql.gaps_statement(
        "SELECT u.col_a, u.col_b, round(u.r, 6) AS r FROM (SELECT "
        + ", ".join(f"corr({a}, {b}) AS {a}__{b}" for a in MEASURES for b in MEASURES)
        + " FROM gaps) w, LATERAL (VALUES "
        + ", ".join(f"('{a}', '{b}', w.{a}__{b})" for a in MEASURES for b in MEASURES)
        + ") u(col_a, col_b, r)"
    )
)
def correlation_pairwise_gaps(spark, sf_dir):
    found = profile.correlation(incomplete(spark, sf_dir), columns=MEASURES, handle_invalid="pairwise")
    return rounded(found, "r")


_GAP_FEATURES = f"""
gap_features AS (SELECT f.* FROM ({sql.features_sql('gaps')}) f)"""


@query(
    sql.gaps_statement(
        f"""SELECT 'input' AS what, count(*) AS "rows" FROM gap_features
UNION ALL SELECT 'scored', count(*) FILTER (WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FEATURES)}) FROM gap_features
UNION ALL SELECT 'unscored', count(*) FILTER (WHERE {' OR '.join(f'{c} IS NULL' for c in FEATURES)}) FROM gap_features
UNION ALL SELECT what, n FROM (
"""
        + "\nUNION ALL\n".join(
            f"SELECT 'without {c}' AS what, count(*) FILTER (WHERE {c} IS NULL) AS n FROM gap_features" for c in FEATURES
        )
        + ") WHERE n > 0",
        _GAP_FEATURES,
    )
)
def score_reconcile(spark, sf_dir):
    """Accounts that came in, got a probability, or were kept back, with the columns they lack."""
    accounts = features.add_features(incomplete(spark, sf_dir))
    fit, unfit = score.route(accounts, scratch_path(spark, "routed"), columns=FEATURES)
    scored = score.positive_score(fit, fitted_forest(spark, sf_dir), "p").where(F.col("p").between(0, 1))
    count = lambda df, what: df.agg(F.count("*").alias("rows")).select(F.lit(what).alias("what"), "rows")
    lacking = unfit.select(F.explode("blocked_by").alias("c")).groupBy(F.concat(F.lit("without "), F.col("c")).alias("what"))
    parts = [count(accounts, "input"), count(scored, "scored"), count(unfit, "unscored"), lacking.agg(F.count("*").alias("rows"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
