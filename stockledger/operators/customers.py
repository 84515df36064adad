"""Customer history (SCD type 2) and the current-customer dimension.

``scd2_merge`` reproduces the source's two merges as joins:

1. *insert*: a source row is added as a new open version unless a stored
   version equals it on all 18 attributes (``left_anti`` join);
2. *close*: a stored version whose customer appears in the source with a
   changed attribute gets ``end_date = run_date`` (left join on the key).

Rows added in step 1 equal their source row, so step 2 never closes them and
can run on the previous snapshot alone; the two results are unioned.

Literal mode (default) keeps the source's comparison rules, with their
consequences: a NULL in a plain-``=`` column never matches (the row is added
again every run, and a value -> NULL change is not closed); matching ignores
``end_date`` (A -> B -> A leaves no open version; closed versions are closed
again with a later date); NULL and 0 are equal in the coalesced columns;
customers missing from a load stay open. ``strict=True`` compares null-safely,
matches and closes open versions only, and ignores exact duplicate source rows.

The insert merge is an anti-join on the 18 match keys against the *distinct*
match keys of the history; the close merge is a left join on the customer
key, where AQE's skew-join splitting handles a customer with very many
versions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.functions.scalar import all_of, any_of, zero_if_null
from stockledger.schemas import CUSTOMER_COLUMNS, CUSTOMER_DIM_COLUMNS

KEY = "c_customer_sk"

# How the source's merge compares each attribute. Ten columns
# use plain "=" / "!=", eight compare COALESCE(x, 0).
PLAIN_COLUMNS = (
    "c_salutation",
    "c_preferred_cust_flag",
    "c_customer_sk",
    "c_login",
    "c_first_name",
    "c_current_addr_sk",
    "c_last_name",
    "c_customer_id",
    "c_birth_country",
    "c_email_address",
)
COALESCED_COLUMNS = (
    "c_first_sales_date_sk",
    "c_current_cdemo_sk",
    "c_current_hdemo_sk",
    "c_last_review_date_sk",
    "c_birth_month",
    "c_birth_year",
    "c_birth_day",
    "c_first_shipto_date_sk",
)

_SRC = "_src_"


def _run_ts(run_date: str):
    return F.lit(run_date).cast("date").cast("timestamp_ntz")


def _tk(c: str) -> str:
    return _SRC + "t_" + c


def _match_keys(hist: DataFrame, strict: bool) -> DataFrame:
    """Distinct match keys of the stored versions that can match a source row.

    Only existence matters to the insert merge, so identical stored versions
    are collapsed first (map-side, before the shuffle), and in literal mode
    versions with a NULL in a plain-``=`` column are dropped because they can
    never match. This keeps the anti-join balanced even when the history holds
    many identical re-inserted versions of one customer.
    """
    if strict:
        keys = hist.where(F.col("end_date").isNull()).select(*[F.col(c).alias(_tk(c)) for c in CUSTOMER_COLUMNS])
    else:
        keys = hist.where(all_of(F.col(c).isNotNull() for c in PLAIN_COLUMNS)).select(
            *[F.col(c).alias(_tk(c)) for c in PLAIN_COLUMNS],
            *[zero_if_null(c).alias(_tk(c)) for c in COALESCED_COLUMNS],
        )
    return keys.distinct()


def _match_condition(strict: bool):
    """Merge-match predicate between a source row and the stored match keys."""
    if strict:
        return all_of(F.col(_tk(c)).eqNullSafe(F.col(c)) for c in CUSTOMER_COLUMNS)
    return all_of(
        [F.col(_tk(c)) == F.col(c) for c in PLAIN_COLUMNS]
        + [F.col(_tk(c)) == zero_if_null(c) for c in COALESCED_COLUMNS]
    )


def _changed(t, s, strict: bool):
    """Change predicate; literal mode keeps three-valued logic (NULL = not changed)."""
    if strict:
        return any_of(~t(c).eqNullSafe(s(c)) for c in CUSTOMER_COLUMNS if c != KEY)
    return any_of(
        [t(c) != s(c) for c in PLAIN_COLUMNS if c != KEY]
        + [zero_if_null(t(c)) != zero_if_null(s(c)) for c in COALESCED_COLUMNS]
    )


def scd2_merge(snapshot: DataFrame, source: DataFrame, run_date: str, strict: bool = False) -> DataFrame:
    """Next version of the customer history after one source load."""
    run_ts = _run_ts(run_date)
    src = source.select(*CUSTOMER_COLUMNS)
    if strict:
        src = src.dropDuplicates()
    hist = snapshot.select(*CUSTOMER_COLUMNS, "start_date", "end_date")

    # 1. insert versions that do not exist yet
    new_rows = src.join(_match_keys(hist, strict), _match_condition(strict), "left_anti").select(
        *CUSTOMER_COLUMNS, run_ts.alias("start_date"), F.lit(None).cast("timestamp_ntz").alias("end_date")
    )

    # 2. close changed versions
    src_r = src.select(*[F.col(c).alias(_SRC + c) for c in CUSTOMER_COLUMNS])
    joined = hist.join(src_r, hist[KEY] == src_r[_SRC + KEY], "left")
    close = F.col(_SRC + KEY).isNotNull() & _changed(lambda c: F.col(c), lambda c: F.col(_SRC + c), strict)
    if strict:
        close = close & F.col("end_date").isNull()
    kept = joined.select(
        *CUSTOMER_COLUMNS,
        "start_date",
        F.when(close, run_ts).otherwise(F.col("end_date")).alias("end_date"),
    )
    return kept.unionByName(new_rows)


def scd2_merge_in_buckets(snapshot: DataFrame, source: DataFrame, run_date: str, strict: bool = False) -> DataFrame:
    """:func:`scd2_merge` for two tables in buckets of the customer key, which stay where they are.

    The customer key is the only join key of both merges. The insert merge
    compares the other attributes as a count of equal ones, which Spark cannot
    take for further join keys (it would shuffle by all of them). Identical
    stored versions are met bucket by bucket, so they need not be collapsed first.
    """
    source.select(*CUSTOMER_COLUMNS).createOrReplaceTempView(load := f"load_{uuid.uuid4().hex}")
    snapshot.select(*CUSTOMER_COLUMNS, "start_date", "end_date").createOrReplaceTempView(held := f"held_{uuid.uuid4().hex}")
    if strict:
        pairs = [(f"t.{c}", f"s.{c}") for c in CUSTOMER_COLUMNS if c != KEY]
        same, seen = "CAST({} <=> {} AS INT)", "t.end_date IS NULL"
        changed = f"t.end_date IS NULL AND ({' OR '.join(f'NOT ({t} <=> {s})' for t, s in pairs)})"
    else:
        pairs = [(f"t.{c}", f"s.{c}") for c in PLAIN_COLUMNS if c != KEY] + [(f"COALESCE(t.{c}, 0)", f"COALESCE(s.{c}, 0)") for c in COALESCED_COLUMNS]
        same = "CAST(COALESCE({} = {}, false) AS INT)"
        seen = " AND ".join(f"t.{c} IS NOT NULL" for c in PLAIN_COLUMNS)
        changed = " OR ".join(f"{t} != {s}" for t, s in pairs)
    every = ", ".join(f"s.{c}" for c in CUSTOMER_COLUMNS)
    new = f"SELECT {every}, CAST(CAST(:day AS DATE) AS TIMESTAMP_NTZ) AS start_date, CAST(NULL AS TIMESTAMP_NTZ) AS end_date"
    alike = f"{seen} AND {' + '.join(same.format(t, s) for t, s in pairs)} = {len(pairs)}"
    if strict:  # a null key equals a null key; the load has one such row at most
        nulls = f"UNION ALL {new} FROM (SELECT * FROM {load} WHERE {KEY} IS NULL) s LEFT ANTI JOIN (SELECT * FROM {held} WHERE {KEY} IS NULL) t ON {seen} AND {' AND '.join(f'{t} <=> {s}' for t, s in pairs)}"
    spark = source.sparkSession
    merged = spark.sql(
        f"""
        SELECT {every.replace("s.", "t.")}, t.start_date,
               CASE WHEN s.{KEY} IS NOT NULL AND ({changed}) THEN CAST(CAST(:day AS DATE) AS TIMESTAMP_NTZ) ELSE t.end_date END AS end_date
        FROM {held} t LEFT JOIN {load} s ON t.{KEY} = s.{KEY}
        UNION ALL
        {new} FROM {load + " s" if not strict else f"(SELECT * FROM {load} WHERE {KEY} IS NOT NULL) s"} LEFT ANTI JOIN {held} t ON t.{KEY} = s.{KEY} AND {alike}
        {nulls if strict else ""}
        """,
        args={"day": run_date},
    )
    for view in (load, held):
        spark.catalog.dropTempView(view)
    return merged


def assert_unique_key(source: DataFrame, key: str = KEY) -> None:
    """Refuse a load with two rows for one customer (the change merge would be ambiguous)."""
    dup = source.groupBy(key).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate {key} in source, e.g. {dup[0][key]}")


def current_versions(snapshot: DataFrame) -> DataFrame:
    return snapshot.where(F.col("end_date").isNull())


#: Shares among which rows without a key are dealt in a join that shuffles.
NULL_SHARES = 1024


def _left_join(left: DataFrame, key: str, right: DataFrame, right_key: str) -> DataFrame:
    """``left LEFT JOIN right ON key = right_key`` with the rows that have no key dealt out.

    A shuffle would send all of them to one partition. The join also compares a
    share, which is 0 where there is a key and comes from the customer where there
    is none, so those rows, which match nothing, spread over all partitions.
    """
    share = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(KEY), F.lit(NULL_SHARES))).otherwise(F.lit(0).cast("long"))
    left = left.withColumn("_share", share)
    right = right.withColumn("_own", F.pmod(F.xxhash64(right_key), F.lit(1)))  # 0, which Spark cannot fold away
    return left.join(right, (left[key] == right[right_key]) & (left["_share"] == right["_own"]), "left").drop("_share", "_own")


def customer_dimension(
    snapshot: DataFrame,
    address: DataFrame,
    demographics: DataFrame,
    household: DataFrame,
    income_band: DataFrame,
) -> DataFrame:
    """Current versions enriched by four left joins.

    The joins form a chain: the income band key comes from the household
    table joined just before. Spark chooses each join from its inputs' sizes.
    """
    cur = current_versions(snapshot)
    j = _left_join(cur, "c_current_addr_sk", address, "ca_address_sk")
    j = _left_join(j, "c_current_cdemo_sk", demographics, "cd_demo_sk")
    j = _left_join(j, "c_current_hdemo_sk", household, "hd_demo_sk")
    j = _left_join(j, "hd_income_band_sk", income_band, "ib_income_band_sk")
    return j.select(*CUSTOMER_DIM_COLUMNS)
