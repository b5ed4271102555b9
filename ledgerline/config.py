"""Configuration: fixed business values and tunable thresholds.

The values in the "fixed values" blocks below must equal the platform
specification for results to match (exchange rates, MCC categories, enums,
rule weights and default thresholds).  They are stated plainly, in their
natural order.
"""

from __future__ import annotations

import json
import logging
import re
from dataclasses import dataclass, field, replace
from decimal import Decimal
from pathlib import Path
from typing import Any

log = logging.getLogger(__name__)

# ---------------------------------------------------------------------------
# Fixed values — currency rates to USD (ISO 4217), as decimal(10,6).
# ---------------------------------------------------------------------------
EXCHANGE_RATES_USD: dict[str, str] = {
    "USD": "1.0",
    "EUR": "1.08",
    "GBP": "1.27",
    "JPY": "0.0067",
    "CAD": "0.74",
    "AUD": "0.65",
    "CHF": "1.12",
    "CNY": "0.14",
}

# ---------------------------------------------------------------------------
# Fixed values — merchant category codes (first four characters of
# merchant_id) to spending category.
# ---------------------------------------------------------------------------
MCC_CATEGORIES: dict[str, str] = {
    "5411": "Groceries",
    "5812": "Restaurants",
    "5541": "Gas Stations",
    "4111": "Transit",
    "7011": "Hotels",
    "4511": "Airlines",
    "5999": "Retail",
    "6011": "ATM",
    "5912": "Pharmacy",
    "7372": "Software",
    "5045": "Electronics",
    "8099": "Healthcare",
}
UNCATEGORIZED = "Uncategorized"

# ---------------------------------------------------------------------------
# Fixed values — enumerations.
# ---------------------------------------------------------------------------
TRANSACTION_TYPES: tuple[str, ...] = ("DEBIT", "CREDIT", "TRANSFER", "REFUND")
STATUSES: tuple[str, ...] = ("PENDING", "SETTLED", "FLAGGED", "REVERSED", "FAILED")
ACTIONS: tuple[str, ...] = ("ALLOW", "FLAG", "BLOCK")
ASSET_TYPES: tuple[str, ...] = (
    "S3_PATH",
    "REDSHIFT_TABLE",
    "GLUE_JOB",
    "LAMBDA",
    "KINESIS_STREAM",
    "QUICKSIGHT_DATASET",
)
HOME_COUNTRY = "US"
HIGH_VALUE_USD = Decimal("10000")

# ---------------------------------------------------------------------------
# Fixed values — fraud rule weights in hundredths of a point (0.40 -> 40),
# in evaluation order, and the rule constants.
# ---------------------------------------------------------------------------
RULE_ORDER: tuple[str, ...] = (
    "HIGH_AMOUNT",
    "UNUSUAL_HOUR",
    "INTERNATIONAL",
    "VELOCITY",
    "NEW_MERCHANT_HIGH_VALUE",
    "CARD_NOT_PRESENT",
)
POINTS_HIGH_AMOUNT = 40
POINTS_UNUSUAL_HOUR = 20
POINTS_HIGH_RISK_COUNTRY = 50
POINTS_INTERNATIONAL = 15
POINTS_VELOCITY = 60
POINTS_NEW_MERCHANT = 35
POINTS_CARD_NOT_PRESENT = 25
MAX_POINTS = 100
UNUSUAL_HOUR_FIRST = 1
UNUSUAL_HOUR_LAST = 4
MISSING_HOUR = 12
NEW_MERCHANT_MIN_USD = 500
VELOCITY_WINDOW_SECONDS = 3600

# ---------------------------------------------------------------------------
# Fixed values — default fraud thresholds.
# ---------------------------------------------------------------------------
DEFAULT_THRESHOLDS: dict[str, Any] = {
    "high_amount_usd": 10000,
    "velocity_per_hour": 10,
    "flag_score": 0.4,
    "block_score": 0.8,
    "high_risk_countries": ["NG", "RO", "KP", "IR"],
}

# Retention (seconds): velocity history 1 h, alerts 90 d, lineage 365 d.
TTL_VELOCITY_S = 3600
TTL_ALERT_S = 90 * 86400
TTL_LINEAGE_S = 365 * 86400


@dataclass(frozen=True)
class Thresholds:
    """Fraud thresholds; any key missing from a partial dict takes its default."""

    high_amount_usd: float = DEFAULT_THRESHOLDS["high_amount_usd"]
    velocity_per_hour: int = DEFAULT_THRESHOLDS["velocity_per_hour"]
    flag_score: float = DEFAULT_THRESHOLDS["flag_score"]
    block_score: float = DEFAULT_THRESHOLDS["block_score"]
    high_risk_countries: tuple[str, ...] = field(
        default_factory=lambda: tuple(DEFAULT_THRESHOLDS["high_risk_countries"])
    )

    @classmethod
    def from_dict(cls, d: dict[str, Any] | None) -> "Thresholds":
        d = dict(d or {})
        base = cls()
        kw: dict[str, Any] = {}
        for k in ("high_amount_usd", "velocity_per_hour", "flag_score", "block_score"):
            if k in d and d[k] is not None:
                kw[k] = d[k]
        if "high_risk_countries" in d and d["high_risk_countries"] is not None:
            kw["high_risk_countries"] = tuple(d["high_risk_countries"])
        return replace(base, **kw)

    @property
    def flag_points(self) -> int:
        return int(round(float(self.flag_score) * 100))

    @property
    def block_points(self) -> int:
        return int(round(float(self.block_score) * 100))


def _read_text(path: str | Path) -> str:
    """A small text file; a path with a scheme is read through Spark's file systems."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:/", str(path)):
        from pyspark.sql import SparkSession

        return SparkSession.active().read.text(str(path), wholetext=True).first()[0]
    return Path(path).read_text()


def load_thresholds(path: str | Path | None, last: Thresholds | None = None) -> Thresholds:
    """SRC8: read a thresholds JSON file; when it is absent or unreadable, log it and use
    ``last`` (the values before, on a reload) or the defaults."""
    if path is None:
        return last or Thresholds()
    try:
        return Thresholds.from_dict(json.loads(_read_text(path)))
    except Exception as e:
        log.warning("thresholds %s can't be read, using %s: %s", path, "the last ones" if last else "the defaults", e)
        return last or Thresholds()


DEFAULT_SUITE_PATH = Path(__file__).resolve().parent.parent / "conf" / "expectations.json"


def load_suite(path: str | Path | None = None) -> dict[str, Any]:
    """SRC9: read an expectation suite (JSON) on the driver."""
    return json.loads(_read_text(path or DEFAULT_SUITE_PATH))


# Job name, asset types with their URI schemes, and metadata of each stage's lineage (LIN4).
STAGE_LINEAGE = {
    "ingest": (
        "financial-ingest-job", "GLUE_JOB", ("S3_PATH", ""), ("S3_PATH", ""),
        {"layer": "raw→bronze", "format": "csv→parquet"},
    ),
    "transform": (
        "financial-transform-job", "GLUE_JOB", ("S3_PATH", ""), ("S3_PATH", ""),
        {"layer": "bronze→silver", "transformations": ["currency_normalize", "dedup", "enrich_category"]},
    ),
    "load": (
        "financial-load-job", "GLUE_JOB", ("S3_PATH", ""), ("REDSHIFT_TABLE", "redshift://"),
        {"layer": "silver→gold", "load_strategy": "upsert"},
    ),
    "fraud": (
        "fraud-detection-lambda", "LAMBDA", ("KINESIS_STREAM", "kinesis://"), ("REDSHIFT_TABLE", "dynamodb://"),
        {"processing_model": "real-time", "engine": "rule-based"},
    ),
}
