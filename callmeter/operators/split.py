"""Reproducible train/val/test splits, and checks that nothing leaks between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callmeter.functions.columns import fingerprint, hash_number, hash_text
from callmeter.schema import SPLITS

SHARES = (70, 15, 15)
SEED = 42


def _split_name(position: Column, shares: Sequence[int]) -> Column:
    """Split of a position in 0 .. sum(shares)."""
    train, val, _ = shares
    return (
        F.when(position < train, SPLITS[0])
        .when(position < train + val, SPLITS[1])
        .otherwise(SPLITS[2])
    )


def random_split(
    df: DataFrame, *, key: str, seed: int = SEED, shares: Sequence[int] = SHARES
) -> DataFrame:
    """Add ``split`` from a hash of the key.

    One projection: no sampling pass, no join, and the same answer for any partitioning,
    row order or re-run. Rows with equal keys stay together.
    """
    bucket = hash_number(F.col(key), seed=seed) % sum(shares)
    return df.withColumn("split", _split_name(bucket, shares))


def content_split(
    df: DataFrame,
    *,
    columns: Sequence[str],
    seed: int = SEED,
    shares: Sequence[int] = SHARES,
) -> DataFrame:
    """Like ``random_split``, keyed by content: equal rows always share a split."""
    bucket = hash_number(fingerprint(columns), seed=seed) % sum(shares)
    return df.withColumn("split", _split_name(bucket, shares))


# Hex digits of hash that order the rows, and that number the cells which are counted.
_ORDER_DIGITS, _CELL_DIGITS = 15, 4


def stratified_split(
    df: DataFrame,
    *,
    key: str,
    label: str,
    classes: Sequence[int] = (0, 1),
    seed: int = SEED,
    shares: Sequence[int] = SHARES,
) -> DataFrame:
    """Add ``split`` so that each class is divided in exactly the given shares.

    Within a class, keys are ordered by hash; the first rows up to the train share are
    train, the next val, the rest test. Rows whose label is none of ``classes`` form one
    class of their own. No row is ranked or shuffled: the key at each share border is
    found by counting hash cells, and every row is compared with it in place. With unique
    keys the shares are exact; rows that share a key stay together.
    """
    known = F.col(label).isin(*classes)
    marked = df.select(
        "*",
        F.when(known, F.col(label).cast("string")).otherwise("other").alias("_class"),
        F.struct(
            F.substring(hash_text(F.col(key), seed=seed), 1, _ORDER_DIGITS).alias("hash"),
            F.col(key).alias("key"),
        ).alias("_place"),
    )
    cuts = _share_borders(marked.select("_class", "_place"), shares)

    def before(border: str) -> Column:
        return F.col(border).isNull() | (F.col("_place") < F.col(border))

    # At most one row per class, and the classes are given.
    return marked.join(F.broadcast(cuts), "_class", "left").select(
        *df.columns,
        F.when(before("_train_end"), SPLITS[0])
        .when(before("_val_end"), SPLITS[1])
        .otherwise(SPLITS[2])
        .alias("split"),
    )


def _share_borders(marked: DataFrame, shares: Sequence[int]) -> DataFrame:
    """Per class, the first place after the train share and after the val share."""
    places = marked.withColumn("_cell", F.substring("_place.hash", 1, _CELL_DIGITS))
    # At most 65,536 rows per class, whatever the size of the table.
    counts = places.groupBy("_class", "_cell").agg(F.count("*").alias("n"))
    of_class = Window.partitionBy("_class")
    earlier = of_class.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counted = counts.select(
        "*",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
        F.sum("n").over(of_class).alias("n_total"),
    )
    whole, train = sum(shares), shares[0]
    ends = {"_train_end": train, "_val_end": train + shares[1]}
    wanted = counted.select(
        "_class",
        "_cell",
        "n",
        "n_before",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("_end"),
                        F.expr(f"n_total * {part} div {whole}").alias("_rank"),
                    )
                    for name, part in ends.items()
                ]
            )
        ),
    ).filter(
        (F.col("n_before") <= F.col("_rank"))
        & (F.col("_rank") < F.col("n_before") + F.col("n"))
    )
    # Two rows per class: the cells that hold the borders. One cell is a 65,536th of its
    # class and copies of a key are counted first, so the ordering inside stays small.
    inside = (
        Window.partitionBy("_class", "_end")
        .orderBy("_place")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    held = (
        places.join(F.broadcast(wanted), ["_class", "_cell"])
        .groupBy("_class", "_end", "_place", "_rank", "n_before")
        .agg(F.count("*").alias("copies"))
        .withColumn("_at", F.col("n_before") + F.coalesce(F.sum("copies").over(inside), F.lit(0)))
        .filter(
            (F.col("_at") <= F.col("_rank")) & (F.col("_rank") < F.col("_at") + F.col("copies"))
        )
    )
    return held.groupBy("_class").agg(
        *[F.max(F.when(F.col("_end") == e, F.col("_place"))).alias(e) for e in ends]
    )


def split_by_ids(df: DataFrame, ids: DataFrame, *, key: str) -> DataFrame:
    """The rows of ``df`` whose key is listed in ``ids``, with the columns of both."""
    return df.join(ids, key)


def summary(df: DataFrame, *, label: str) -> DataFrame:
    """Rows, share of all rows and positive rate of each split."""
    sizes = df.groupBy("split").agg(
        F.count("*").alias("rows"), F.avg(label).alias("positive_rate")
    )
    whole = sizes.agg(F.sum("rows")).scalar()
    return sizes.select(
        "split",
        "rows",
        (F.col("rows") / whole).alias("share"),
        "positive_rate",
    )


def row_hash(df: DataFrame, *, columns: Sequence[str]) -> DataFrame:
    """Add ``row_hash``, a fingerprint of the given columns."""
    return df.withColumn("row_hash", fingerprint(columns))


def distinct_contents(df: DataFrame, *, columns: Sequence[str]) -> DataFrame:
    """The distinct fingerprints of a table."""
    return row_hash(df, columns=columns).select("row_hash").distinct()


def overlap(df: DataFrame, *, columns: Sequence[str]) -> DataFrame:
    """For each two splits, how many distinct row contents occur in both.

    One grouping by content; its state is one small integer, so a content that fills a
    third of the table is merged before the shuffle.
    """
    bit = F.lit(0)
    for i, name in enumerate(SPLITS):
        bit = F.when(F.col("split") == name, 1 << i).otherwise(bit)
    # The digest as bytes: half the shuffle of its hex form.
    found = df.groupBy(F.unhex(fingerprint(columns)).alias("_content")).agg(
        F.bit_or(bit).alias("_in")
    )
    pairs = [(0, 1), (0, 2), (1, 2)]
    both = lambda a, b: (1 << a) | (1 << b)
    wide = found.agg(
        *[
            F.count_if(F.col("_in").bitwiseAND(both(a, b)) == both(a, b)).alias(f"_{a}{b}")
            for a, b in pairs
        ]
    )
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(SPLITS[a]).alias("split_a"),
                        F.lit(SPLITS[b]).alias("split_b"),
                        F.col(f"_{a}{b}").alias("shared_contents"),
                    )
                    for a, b in pairs
                ]
            )
        )
    )


def reconcile(source: DataFrame, df: DataFrame) -> DataFrame:
    """Source rows against the rows of all splits, in one row."""
    sides = source.groupBy(F.lit("source").alias("side")).agg(F.count("*").alias("rows"))
    sides = sides.unionByName(
        df.groupBy(F.col("split").alias("side")).agg(F.count("*").alias("rows"))
    )
    of = lambda side: F.coalesce(
        F.sum(F.when(F.col("side") == side, F.col("rows"))), F.lit(0)
    )
    parts = sides.agg(
        of("source").alias("source_rows"), *[of(s).alias(f"{s}_rows") for s in SPLITS]
    )
    total = sum((F.col(f"{s}_rows") for s in SPLITS), F.lit(0))
    return parts.select(
        "*",
        total.alias("split_rows"),
        (F.col("source_rows") - total).alias("difference"),
    )


def first_rows(df: DataFrame, *, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest keys; each task keeps only its own ``n``."""
    return df.orderBy(key).limit(n)


def contrast_sample(
    df: DataFrame, *, label: str, key: str, positives: int = 3, negatives: int = 2
) -> DataFrame:
    """The first positives and the first negatives by key, numbered from 1."""
    picked = first_rows(df.filter(F.col(label) == 1), key=key, n=positives).unionByName(
        first_rows(df.filter(F.col(label) == 0), key=key, n=negatives)
    )
    # Numbering works on the sample alone, positives + negatives rows.
    ordered = F.array_sort(
        F.collect_list(F.struct((-F.col(label)).alias("_rank"), key, F.struct("*").alias("_row")))
    )
    return (
        picked.agg(ordered.alias("_sample"))
        .select(F.posexplode("_sample").alias("_at", "_item"))
        .select((F.col("_at") + 1).alias("client_id"), "_item._row.*")
    )
