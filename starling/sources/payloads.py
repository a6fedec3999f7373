"""Ledger payloads: base64, zlib, JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.ledger import inflate
from starling.schemas import LEDGER


def decode_payload(df: DataFrame, column: str = "payload") -> DataFrame:
    """Add `ledger`, the decoded payload, whatever its size; null where the payload cannot be read."""
    return df.withColumn("ledger", F.from_json(inflate(F.col(column)), LEDGER))
