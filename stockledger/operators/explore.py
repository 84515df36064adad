"""Exploration and profiling queries: bounds, arrivals, key probes, cadence,
cardinality and calendar lookups.

Each is one distributed plan. Bounds use an uncorrelated scalar subquery
(computed once, then a filter on the calendar); ``ORDER BY ... LIMIT n`` plans
as ``TakeOrderedAndProject`` (per-partition top-n, then a merge of n rows per
partition), so the limit never pulls a table through one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def date_of_key_bound(fact: DataFrame, key: str, date_dim: DataFrame, bound: str = "min") -> DataFrame:
    """``SELECT cal_dt FROM date_dim WHERE d_date_sk = (SELECT min|max(key) FROM fact)``."""
    agg = F.min(key) if bound == "min" else F.max(key)
    return date_dim.where(F.col("d_date_sk") == fact.select(agg).scalar()).select("cal_dt")


def daily_arrivals(fact: DataFrame, key: str, date_dim: DataFrame, n: int = 10) -> DataFrame:
    """Rows per day for the latest ``n`` days with rows (inner join with the calendar)."""
    cal = date_dim.select("d_date_sk", "cal_dt")
    j = fact.select(key).join(cal, fact[key] == cal["d_date_sk"], "inner")
    return (
        j.groupBy("cal_dt", key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.col("cal_dt").desc())
        .limit(n)
    )


def key_probe_count(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Row count of ``fact JOIN dim ON fact_key = dim_key``.

    Computed as the sum over keys of (fact rows x dimension rows) after
    counting each side per key: partial counts are taken before the shuffle,
    so only one row per distinct key and task crosses the network, never the
    fact rows, and a hot key costs nothing extra. Both counts come out
    hash-partitioned on the key, so the final join adds no shuffle.
    """
    f = fact.groupBy(F.col(fact_key).alias("_k")).agg(F.count(F.lit(1)).alias("_nf"))
    d = dim.groupBy(F.col(dim_key).alias("_k")).agg(F.count(F.lit(1)).alias("_nd"))
    return f.join(d, "_k").agg(
        F.coalesce(F.sum(F.col("_nf") * F.col("_nd")), F.lit(0)).cast("bigint").alias("n_matched")
    )


def key_probe_preview(
    fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str, order: Sequence[str], n: int = 5
) -> DataFrame:
    """``SELECT fact.*, dim.* FROM fact JOIN dim ... LIMIT n``, the first ``n`` by the key,
    then ``order``, then every other column, so that the preview is repeatable.

    Each matched key has a row at least, so the ``n`` least matched keys hold
    the first ``n`` joined rows; they come from the distinct keys of both
    sides (partial distinct before the shuffle). The fact is filtered by these
    keys and cut to its first ``n`` rows (top-n per partition), which then meet
    their dimension rows. What is broadcast has at most ``n`` rows, and no fact row is shuffled."""
    keys = fact.select(F.col(fact_key).alias("_k")).distinct().join(dim.select(F.col(dim_key).alias("_k")).distinct(), "_k")
    least = keys.orderBy("_k").limit(n)

    def first(df: DataFrame) -> DataFrame:
        columns = dict.fromkeys([fact_key, *order, *df.columns])
        return df.orderBy(*[F.col(c).asc_nulls_first() for c in columns]).limit(n)

    f = first(fact.join(F.broadcast(least), fact[fact_key] == least["_k"], "left_semi"))
    return first(dim.join(F.broadcast(f), dim[dim_key] == f[fact_key]))


def key_probes(fact: DataFrame, pairs: Sequence[tuple[str, str, DataFrame, str]], order: Sequence[str], n: int = 5) -> DataFrame:
    """Every probe of one fact: (probe, kind, value, *order, dim_row).

    ``pairs``: (name, fact key, dimension, its key). A row of kind ``count`` has
    the number of joined rows; the rows of kind ``sample`` are the first ``n``
    joined rows by key and ``order``, with the dimension's row as text.

    The fact's keys are stacked to (pair, key) rows and counted in one scan,
    partially before the shuffle; the counts meet the dimensions' stacked keys
    in one join. For the samples a second scan keeps, per pair, the rows of the
    ``n`` least matched keys: first and top rows are cut per task before they are
    shuffled, and what is broadcast has at most ``n`` rows a pair.
    """
    order = list(order)
    at = range(len(pairs))

    def stacked(columns: Sequence[str]) -> DataFrame:
        cells = [x for i in at for x in (F.lit(i), F.col(pairs[i][1]))]
        return fact.select(*columns, F.stack(F.lit(len(pairs)), *cells).alias("_p", "_k")).where(F.col("_k").isNotNull())

    def first(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        place = Window.partitionBy("_p").orderBy(*columns)
        return df.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= n).drop("_n")

    def dims(*extra) -> DataFrame:
        return reduce(DataFrame.unionByName, [d.select(F.lit(i).alias("_p"), F.col(k).alias("_k"), *[e(d) for e in extra]) for i, (_, _, d, k) in enumerate(pairs)])

    spark = fact.sparkSession
    names = spark.createDataFrame([(i, pairs[i][0]) for i in at], "_p int, probe string")
    f = stacked([]).groupBy("_p", "_k").agg(F.count(F.lit(1)).alias("_nf"))
    d = dims().where(F.col("_k").isNotNull()).groupBy("_p", "_k").agg(F.count(F.lit(1)).alias("_nd"))
    matched = f.join(d, ["_p", "_k"])
    counts = matched.groupBy("_p").agg(F.sum(F.col("_nf") * F.col("_nd")).alias("value"))
    none = [F.lit(None).cast(fact.schema[c].dataType).alias(c) for c in order]
    counted = names.join(counts, "_p", "left").select(
        "probe", F.lit("count").alias("kind"), F.coalesce("value", F.lit(0)).cast("bigint").alias("value"), *none, F.lit(None).cast("string").alias("dim_row")
    )
    least = first(matched.select("_p", "_k"), ["_k"])
    rows = first(stacked(order).join(F.broadcast(least), ["_p", "_k"], "left_semi"), ["_k", *order])
    text = dims(lambda df: F.concat_ws("|", *[F.coalesce(df[c].cast("string"), F.lit("")) for c in df.columns]).alias("dim_row"))
    sampled = first(text.join(F.broadcast(rows), ["_p", "_k"]), ["_k", *order, "dim_row"]).join(names, "_p")
    return counted.unionByName(sampled.select("probe", F.lit("sample").alias("kind"), F.col("_k").cast("bigint").alias("value"), *order, "dim_row"))


def preview(df: DataFrame, order: Sequence[str], n: int = 100) -> DataFrame:
    """``SELECT * FROM t LIMIT n`` made repeatable: ordered by ``order`` and then
    by every other column (NULLs first), so ties cannot pick different rows.
    Plans as top-n per partition, then a merge of n rows per partition."""
    cols = list(dict.fromkeys([*order, *df.columns]))
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in cols]).limit(n)


def rows_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``SELECT k1, k2, count(*) ... GROUP BY 1, 2 ORDER BY 2, 1``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(*reversed(list(keys)))


def days_with_item(fact: DataFrame, day_key: str, item_key: str, item, date_dim: DataFrame,
                   item_dim: DataFrame | None = None, item_dim_key: str = "i_item_sk",
                   ordered: bool = True) -> DataFrame:
    """Distinct ``(cal_dt, wk_num)`` on which one item appears in a fact table.

    The constant item predicate is applied to the fact before the joins (and
    reaches the Parquet scan as a pushed filter). ``ordered=False`` skips the
    final sort for callers that combine several results and sort once."""
    f = fact.where(F.col(item_key) == F.lit(item)).select(day_key, item_key)
    cal = date_dim.select("d_date_sk", "cal_dt", "wk_num")
    j = f.join(cal, f[day_key] == cal["d_date_sk"], "inner")
    if item_dim is not None:
        i = item_dim.select(F.col(item_dim_key).alias("_item"))
        j = j.join(i, j[item_key] == i["_item"], "inner")
    days = j.select("cal_dt", "wk_num").distinct()
    return days.orderBy("cal_dt", "wk_num") if ordered else days


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``SELECT DISTINCT cols ... ORDER BY 1``."""
    return df.select(*columns).distinct().orderBy(columns[0])


def distinct_count(df: DataFrame, column: str, alias: str) -> DataFrame:
    """``SELECT count(DISTINCT col)``: partial distinct per partition, then a count."""
    return df.agg(F.countDistinct(column).alias(alias))


def null_count(df: DataFrame, column: str, alias: str = "n_null") -> DataFrame:
    return df.where(F.col(column).isNull()).agg(F.count(F.lit(1)).alias(alias))


def calendar_head(date_dim: DataFrame, n: int = 100) -> DataFrame:
    return date_dim.select("cal_dt", "d_date_sk").orderBy("cal_dt").limit(n)


def calendar_day(date_dim: DataFrame, day: str) -> DataFrame:
    """``SELECT * FROM date_dim WHERE cal_dt = 'yyyy-mm-dd'`` (string literal cast to date)."""
    return date_dim.where(F.col("cal_dt") == F.lit(day).cast("date"))


def distinct_bitmaps(df: DataFrame, slice_col: str, column: str) -> DataFrame:
    """(slice, bucket, bits): the distinct whole numbers of ``column`` in each slice, as exact bitmaps.

    A bucket covers a fixed range of values, so bitmaps of slices can be joined
    by OR: a count over any set of slices needs no detail rows (:func:`distinct_of_bitmaps`).
    """
    v = F.col(column)
    found = df.where(v.isNotNull() & F.col(slice_col).isNotNull())
    return found.groupBy(F.col(slice_col).alias("slice"), F.bitmap_bucket_number(v).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("bits"))


def distinct_of_bitmaps(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(``by``, n_distinct): COUNT(DISTINCT) over all slices of each group, from their bitmaps."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias("n_distinct"))
