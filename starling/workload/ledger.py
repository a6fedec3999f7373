"""Queries: ledger payloads and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from starling.functions import ledger as fn
from starling.operators import ledger as ops
from starling.plans.ledger import ledger_report
from starling.session import materialize
from starling.sources.payloads import decode_payload
from starling.workload.adapters import BLOCKS_PER_PAYLOAD
from starling.workload.registry import query

_TXS = "SELECT chain_id, pos, idx, time, send, recv, amt, fee, hash, sig FROM ledger_txs"
_BLOCK_SIZES = "SELECT chain_id, pos, id, hash, pow, target, len(string_split(hashes, '|')) AS txs FROM ledger_blocks"


def _exploded(t):
    return ops.explode_ledger(decode_payload(t.payloads), BLOCKS_PER_PAYLOAD)


def _audit(name, build):
    query(f"ledger_{name}", f"SELECT * FROM bad_{_VIEW[name]}")(build)


_VIEW = {
    "block_ids": "ids",
    "amounts": "amounts",
    "time_order": "times",
    "balance": "balances",
    "rewards": "rewards",
    "tx_hash": "tx_hashes",
    "block_hash": "block_hashes",
    "target": "targets",
    "signature": "signatures",
}

query("ledger_decode", _TXS)(lambda t: _exploded(t)[1])
query("ledger_explode", _BLOCK_SIZES)(
    lambda t: _exploded(t)[0].withColumn("txs", F.size("tx_hashes").cast("bigint")).drop("tx_hashes")
)
_audit("block_ids", lambda t: ops.bad_ids(t.ledger_blocks))
_audit("amounts", lambda t: ops.bad_amounts(t.ledger_txs))
_audit("time_order", lambda t: ops.bad_times(t.ledger_txs))
_audit("balance", lambda t: ops.bad_balances(t.ledger_txs))
_audit("rewards", lambda t: ops.bad_rewards(t.ledger_blocks, t.ledger_txs))
_audit("tx_hash", lambda t: ops.bad_tx_hashes(t.ledger_txs))
_audit("block_hash", lambda t: ops.bad_block_hashes(t.ledger_blocks))
_audit("target", lambda t: ops.bad_targets(t.ledger_blocks))
_audit("signature", lambda t: ops.bad_signatures(t.ledger_txs))
# With this exponent of 41 bits a number is its own signature: it is one more than four times the order of the group. The
# other exponents, beside it, sign falsely.
_IDENTITY = 1561903844033
_KEYED = f"""SELECT event_id, {_IDENTITY} + CASE WHEN event_id % 3 = 0 THEN 2 * (user_id + 1) ELSE 0 END AS send,
  (event_id * 7919 + user_id) % 1561906343821 AS sig FROM events"""
query(
    "ledger_signature_keys",
    f"""SELECT event_id, sig, power FROM (SELECT event_id, sig, CAST(list_reduce(list_transform(
    list_concat([-1], string_split(bin(send), '')::INTEGER[]), lambda b: CAST(b AS HUGEINT)),
    lambda p, b: CASE WHEN p < 0 THEN sig ELSE (p * p) % 1561906343821 * (CASE b WHEN 1 THEN sig ELSE 1 END) % 1561906343821 END)
    AS BIGINT) AS power FROM ({_KEYED}) AS k) AS x WHERE power <> sig""",
)(
    lambda t: t.read("events")
    .select(
        "event_id",
        (F.lit(_IDENTITY) + F.when(F.col("event_id") % 3 == 0, 2 * (F.col("user_id") + 1)).otherwise(0)).alias("send"),
        ((F.col("event_id") * 7919 + F.col("user_id")) % fn.SIGNATURE_MODULUS).alias("sig"),
    )
    .where(~fn.signature_holds(F.col("sig"), F.col("send"), F.lower(F.hex("sig"))))
    .select("event_id", "sig", fn.power_mod(F.col("sig"), F.col("send")).alias("power"))
)
_VERDICT = """SELECT chain_id, chain_id NOT IN (SELECT chain_id FROM invalid) AS valid
  FROM (SELECT DISTINCT chain_id FROM ledger_txs) AS c"""


def _verdict(t):
    blocks, txs = materialize(t.ledger_blocks, "blocks"), materialize(t.ledger_txs, "txs")
    return ops.verdicts(blocks, ops.invalid_chains(blocks, txs))


query("ledger_verdict", _VERDICT)(_verdict)
query("q_ledger_verdict", _VERDICT)(lambda t: ledger_report(t.payloads, BLOCKS_PER_PAYLOAD))
