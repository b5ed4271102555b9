"""Medallion ETL operators: raw -> bronze -> silver -> fact.

All functions are pure ``DataFrame -> DataFrame`` transformations.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from decimal import Decimal
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..schemas import FACT_COLUMNS, FACT_TYPES, UPSERT_UPDATE_COLUMNS

REQUIRED_PROFILE_COLUMNS = ("transaction_id", "account_id", "transaction_date", "amount", "currency")


PII_COLUMNS = ("account_id", "ip_address")
#: FLT1: columns a valid row has, and those whose values are from a fixed set.
VALID_PRESENT = ("transaction_id", "account_id", "amount")
STRICT_PRESENT = ("transaction_date", "currency")
VALID_SETS = {"transaction_type": C.TRANSACTION_TYPES, "status": C.STATUSES}


# ---------------------------------------------------------------- PRJ1 / PRJ2 (ingest)
def mask_pii(df: DataFrame, salt: str | None = None) -> DataFrame:
    """PRJ1: SHA-256 hex of the PII columns (of the salt and the value, if salted); NULL stays NULL."""
    return df.withColumns({c: F.sha2(F.concat(F.lit(salt or ""), F.col(c)), 256) for c in PII_COLUMNS})


def add_ingestion_metadata(df: DataFrame, source_path: "str | Column | None" = None) -> DataFrame:
    """PRJ2: ingestion timestamp/date and source file.

    ``source_path`` may be a literal path or a Column; with ``None`` the
    per-row file of the scan (``_metadata.file_path``) is used, which needs
    ``df`` to be the scan itself.
    """
    if source_path is None:
        src = F.col("_metadata.file_path")
    elif isinstance(source_path, Column):
        src = source_path
    else:
        src = F.lit(source_path)
    return df.withColumns(
        {"ingestion_timestamp": F.current_timestamp(), "source_file": src, "ingestion_date": F.current_date()}
    )


# ---------------------------------------------------------------- FLT1-3 / SET1 (validity)
def validity_predicate(strict: bool = False) -> Column:
    """FLT1: id, account and amount present; type and status in their enum sets.

    ``strict=True`` also requires transaction_date and currency (the two
    profiled columns the shipped filter leaves out).  NULL -> invalid.
    """
    present = VALID_PRESENT + (STRICT_PRESENT if strict else ())
    tests = [F.col(c).isNotNull() for c in present] + [F.col(c).isin(*v) for c, v in VALID_SETS.items()]
    return F.coalesce(reduce(and_, tests), F.lit(False))


def null_profile(df: DataFrame, columns: Sequence[str] = REQUIRED_PROFILE_COLUMNS) -> DataFrame:
    """FLT2: one row, ``null_<col>`` = number of NULLs per column (single pass)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def split_valid(df: DataFrame, strict: bool = False, distinct_quarantine: bool = False) -> tuple[DataFrame, DataFrame]:
    """FLT3/SET1: (valid, quarantine).  valid ∪ quarantine = input, duplicates kept.

    ``distinct_quarantine=True`` reproduces EXCEPT DISTINCT (``subtract``) semantics.
    """
    flagged = df.withColumn("_is_valid", validity_predicate(strict))
    valid = flagged.where("_is_valid").drop("_is_valid")
    quarantine = flagged.where(~F.col("_is_valid")).drop("_is_valid")
    if distinct_quarantine:
        quarantine = df.subtract(valid)
    return valid, quarantine


# ---------------------------------------------------------------- PRJ3-9 (transform)
def _rate_map(rates: dict[str, str]) -> Column:
    kv: list[Column] = []
    for k, v in rates.items():
        kv += [F.lit(k), F.lit(Decimal(v)).cast("decimal(10,6)")]
    return F.create_map(*kv)


def normalize_currency(
    df: DataFrame, rates: dict[str, str] | None = None, default_rate: str | None = None
) -> DataFrame:
    """PRJ3: exchange_rate (decimal(10,6)) and amount_usd = round(amount * rate, 2).

    Unknown or NULL currency -> NULL rate and amount (``default_rate`` overrides).
    Exact decimal arithmetic: no float rounding at half cents.
    """
    rate = _rate_map(rates or C.EXCHANGE_RATES_USD)[F.col("currency")]
    if default_rate is not None:
        rate = F.coalesce(rate, F.lit(Decimal(default_rate)).cast("decimal(10,6)"))
    return df.withColumns(
        {"exchange_rate": rate, "amount_usd": F.round(F.col("amount") * rate, 2).cast("decimal(18,2)")}
    )


def enrich_category(df: DataFrame, mcc: dict[str, str] | None = None) -> DataFrame:
    """PRJ4: keep category; else MCC map on merchant_id[0:4]; else 'Uncategorized'."""
    kv: list[Column] = []
    for k, v in (mcc or C.MCC_CATEGORIES).items():
        kv += [F.lit(k), F.lit(v)]
    by_mcc = F.create_map(*kv)[F.substring(F.col("merchant_id"), 1, 4)]
    return df.withColumn("category", F.coalesce(F.col("category"), by_mcc, F.lit(C.UNCATEGORIZED)))


def add_derived_columns(df: DataFrame) -> DataFrame:
    """PRJ5-9: day_of_week (1=Sunday), is_weekend, transaction_hour, is_international, is_high_value."""
    hour = F.hour(F.try_to_timestamp(F.col("transaction_time"), F.lit("HH:mm:ss")))
    dow = F.dayofweek("transaction_date")
    return df.withColumns(
        {
            "day_of_week": dow.cast("smallint"),
            "is_weekend": dow.isin(1, 7),
            "transaction_hour": hour.cast("smallint"),
            "is_international": F.col("country_code") != F.lit(C.HOME_COUNTRY),
            "is_high_value": F.col("amount_usd") > F.lit(C.HIGH_VALUE_USD),
        }
    )


# ---------------------------------------------------------------- WIN1 (dedupe)
def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_desc: Sequence[str],
    hash_tiebreak: bool = False,
) -> DataFrame:
    """WIN1: keep one row per key — the greatest by ``order_desc`` (NULLs lowest).

    Expressed as ``max_by(row, struct(order...))`` per key rather than a
    ``row_number`` window: the aggregate is combined map-side, so a key
    holding a large share of all copies never lands whole in one task.
    ``hash_tiebreak`` appends an xxhash64 of the whole row, making the pick
    deterministic when the order columns tie.
    """
    keys = list(keys)
    all_cols = df.columns  # one schema round-trip
    others = [c for c in all_cols if c not in keys]
    order: list[Column] = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order_desc)]
    if hash_tiebreak:
        order.append(F.xxhash64(*[F.col(c) for c in all_cols]).alias("_oh"))
    row = F.struct(*[F.col(c) for c in others])
    out = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row"))
    pos = {c: (F.col(c) if c in keys else F.col(f"_row.{c}").alias(c)) for c in all_cols}
    return out.select(*[pos[c] for c in all_cols])


def has_repeats(df: DataFrame, key: str) -> bool:
    """Does a key (null is one) come more than once?  Shuffles that column only, where ``dedupe_latest`` shuffles
    whole rows, which without repeats it leaves as they are."""
    return not df.groupBy(key).count().where("count > 1").isEmpty()


def deduplicate_transactions(df: DataFrame) -> DataFrame:
    """WIN1 on transactions: latest updated_at, then created_at, then row hash."""
    return dedupe_latest(df, ["transaction_id"], ["updated_at", "created_at"], hash_tiebreak=True)


def to_silver(
    bronze: DataFrame, rates: dict[str, str] | None = None, default_rate: str | None = None, dedupe: bool = True
) -> DataFrame:
    """JOB2 body: normalise -> enrich -> dedupe (unless the ids are known to be unique) -> derive (same order as the platform)."""
    df = normalize_currency(bronze, rates, default_rate)
    df = enrich_category(df)
    if dedupe:
        df = deduplicate_transactions(df)
    return add_derived_columns(df)


# ---------------------------------------------------------------- DIM1 (conformed fact)
def conform_fact(df: DataFrame) -> DataFrame:
    """DIM1: 26-column fact projection in warehouse order with warehouse types.

    Missing metadata columns are filled with NULL so any silver frame conforms.
    """
    cols = []
    present = set(df.columns)
    for c in FACT_COLUMNS:
        src = F.col(c) if c in present else F.lit(None)
        cols.append(src.cast(FACT_TYPES[c]).alias(c))
    return df.select(*cols)


# ---------------------------------------------------------------- JOIN1/JOIN2/SET2 (upsert)
def upsert(
    target: DataFrame,
    staging: DataFrame,
    key: str = "transaction_id",
    update_columns: Iterable[str] = UPSERT_UPDATE_COLUMNS,
    dedupe_staging: bool = True,
) -> DataFrame:
    """SNK5: merge ``staging`` into ``target`` by ``key`` in one full outer join.

    Matched rows take the ``update_columns`` from staging (NULLs overwrite),
    every other column from target; staging-only rows are inserted whole
    (matched by name); target-only rows pass through.  Idempotent.  One
    shuffle per side on the unique key, so no key can skew it.
    """
    update_columns = set(update_columns)
    if dedupe_staging:
        staging = dedupe_latest(staging, [key], ["updated_at"], hash_tiebreak=True)
    cols = target.columns
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in cols], F.lit(True).alias("_in_t"))
    s = staging.select(*[F.col(c).alias(f"s_{c}") for c in cols], F.lit(True).alias("_in_s"))
    j = t.join(s, F.col(f"t_{key}") == F.col(f"s_{key}"), "full_outer")
    in_t = F.coalesce(F.col("_in_t"), F.lit(False))
    in_s = F.coalesce(F.col("_in_s"), F.lit(False))
    out = []
    for c in cols:
        if c in update_columns:
            v = F.when(in_s, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}"))
        else:
            v = F.when(in_t, F.col(f"t_{c}")).otherwise(F.col(f"s_{c}"))
        out.append(v.alias(c))
    return j.select(*out)


def upsert_update_half(
    target: DataFrame, staging: DataFrame, key: str = "transaction_id", update_columns=UPSERT_UPDATE_COLUMNS
) -> DataFrame:
    """JOIN1: rows of target that staging updates, with their new values."""
    update_columns = list(update_columns)
    s = staging.select(key, *[F.col(c).alias(f"s_{c}") for c in update_columns])
    j = target.join(s, key, "inner")
    tcols = target.columns
    return j.select(*[F.col(f"s_{c}").alias(c) if c in update_columns else F.col(c) for c in tcols])


def upsert_insert_half(target: DataFrame, staging: DataFrame, key: str = "transaction_id") -> DataFrame:
    """JOIN2: staging rows whose key is absent from target (anti join)."""
    return staging.join(target.select(key), key, "left_anti").select(*target.columns)
