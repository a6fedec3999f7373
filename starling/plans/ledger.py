"""Payloads to verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starling.operators.ledger import explode_ledger, invalid_chains, verdicts
from starling.session import materialize
from starling.sources.payloads import decode_payload


def ledger_report(payloads: DataFrame, blocks_per_part: int = 0) -> DataFrame:
    """Whether each chain of the payload table (chain_id, part, payload) is valid. One that cannot be read is not.

    Decoded once and stored: the audits read it several times, each with its own fields.
    """
    decoded = materialize(decode_payload(payloads).drop("payload"), "ledger")
    blocks, txs = explode_ledger(decoded, blocks_per_part)
    broken = decoded.where("ledger.chain IS NULL").select("chain_id")
    return verdicts(decoded, invalid_chains(blocks, txs).unionByName(broken))
