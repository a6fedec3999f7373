"""Audits of ledgers of hashed transactions. Each returns the rows that break its rule.

Tables: blocks (chain_id, pos, id, hash, pow, target, prev_hash, tx_hashes) and txs (chain_id, pos, idx, time, send,
recv, amt, fee, hash, sig), amt and fee as text. The hash and number rules look at one row each. The rules that follow
a chain in order work on segments of SEGMENT_BLOCKS blocks: windows run inside a segment and one value per segment is
carried to the next, so a chain or account that holds much of the ledger is spread over many tasks. A block itself
arrives inside one payload, which bounds it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starling.functions import ledger as fn

SEGMENT_BLOCKS = 1024


def explode_ledger(decoded: DataFrame, blocks_per_part: int = 0) -> tuple[DataFrame, DataFrame]:
    """Blocks and transactions of decoded payloads (chain_id, part, ledger).

    A chain may come in parts of a fixed number of blocks; one payload is part 0. What depends on the neighbour in
    the payload, the previous hash and the hashes of a block's transactions, is taken inside the row.
    """
    chain = F.col("ledger.chain")
    offset = (F.col("part") * blocks_per_part).cast("bigint")
    placed = decoded.select("chain_id", offset.alias("_offset"), chain.alias("_chain"), F.posexplode(chain))
    at = F.col("_offset") + F.col("pos")
    hashes = F.transform(
        F.coalesce(F.col("col.all_tx.hash"), F.array().cast("array<string>")), lambda h: F.coalesce(h, F.lit(""))
    )
    blocks = placed.select(
        "chain_id",
        at.alias("pos"),
        F.col("col.id").alias("id"),
        F.col("col.hash").alias("hash"),
        F.col("col.pow").alias("pow"),
        F.col("col.target").alias("target"),
        hashes.alias("tx_hashes"),
    )
    lists = placed.select("chain_id", at.alias("pos"), F.posexplode("col.all_tx").alias("idx", "tx"))
    txs = lists.select("chain_id", "pos", F.col("idx").cast("bigint").alias("idx"), "tx.*")
    return blocks, txs


def _id_broken() -> Column:
    return F.col("id").isNull() | (F.col("id") != F.col("pos"))


def _amount_broken() -> Column:
    amount, fee = fn.whole_number(F.col("amt")), fn.whole_number(F.col("fee"))
    return amount.isNull() | (amount < 0) | (F.col("fee").isNotNull() & (fee.isNull() | (fee < 0)))


def _tx_hash_broken() -> Column:
    due = fn.tx_hash(*(F.col(c) for c in ("time", "send", "recv", "amt", "fee")))
    return F.coalesce("hash", F.lit("")) != due


def _block_hash_broken() -> Column:
    due = fn.block_hash(F.col("id"), F.col("prev_hash"), F.col("tx_hashes"), F.col("pow"))
    return due.isNull() | (F.coalesce("hash", F.lit("")) != due)


def _target_broken() -> Column:
    return F.col("target").isNull() | (F.coalesce("hash", F.lit("")) > F.col("target"))


def bad_ids(blocks: DataFrame) -> DataFrame:
    """The id of a block is its position."""
    return blocks.where(_id_broken()).select("chain_id", "pos", "id")


def bad_amounts(txs: DataFrame) -> DataFrame:
    """The amount is a number and not negative, nor is the fee where there is one. Fractions are cut off."""
    return txs.where(_amount_broken()).select("chain_id", "pos", "idx", "amt", "fee")


def _before(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Add `before`: the last non-null value of the rows before, by segments of blocks."""
    cut = df.withColumn("_seg", F.floor(F.col("pos") / SEGMENT_BLOCKS))
    inside = Window.partitionBy(*keys, "_seg").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn("_local", F.last(value, ignorenulls=True).over(inside))
    tail = F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order)))
    tails = cut.groupBy(*keys, "_seg").agg(tail.alias("_tail"))
    earlier = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.withColumn("_carry", F.last("_tail", ignorenulls=True).over(earlier)).drop("_tail")
    joined = local.join(carried, [*keys, "_seg"], "left")
    return joined.withColumn("before", F.coalesce("_local", "_carry")).drop("_local", "_carry", "_seg")


def bad_times(txs: DataFrame) -> DataFrame:
    """A time is a number not lower than the one before in the chain; the first is not negative."""
    timed = txs.select("chain_id", "pos", "idx", "time", F.col("time").try_cast("bigint").alias("_t"))
    ordered = _before(timed, ["chain_id"], ["pos", "idx"], "_t")
    late = F.col("_t").isNull() | (F.col("_t") < F.coalesce("before", F.lit(0)))
    return ordered.where(late).select("chain_id", "pos", "idx", "time")


def bad_balances(txs: DataFrame) -> DataFrame:
    """A sender has appeared before and holds the amount. Fees are not charged; the debit precedes the credit."""
    amount = fn.whole_number(F.col("amt"))
    entry = "struct<account:bigint,side:int,delta:bigint>"
    debit = F.struct(F.col("send"), F.lit(0), -amount).cast(entry)
    credit = F.struct(F.col("recv"), F.lit(1), amount).cast(entry)
    entries = (
        txs.select("chain_id", "pos", "idx", F.inline(F.array(debit, credit)))
        .where("account IS NOT NULL")
        .withColumn("_seg", F.floor(F.col("pos") / SEGMENT_BLOCKS))
    )
    account = ["chain_id", "account"]
    inside = Window.partitionBy(*account, "_seg").orderBy("pos", "idx", "side")
    earlier_rows = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = entries.withColumns(
        {"_sum": F.sum("delta").over(earlier_rows), "_count": F.count("*").over(earlier_rows)}
    )
    totals = entries.groupBy(*account, "_seg").agg(F.sum("delta").alias("_s"), F.count("*").alias("_c"))
    earlier = Window.partitionBy(*account).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *account, "_seg", F.sum("_s").over(earlier).alias("_carry"), F.sum("_c").over(earlier).alias("_carried")
    )
    zero = F.lit(0)
    known = F.col("_count") + F.coalesce("_carried", zero)
    balance = F.coalesce("_sum", zero) + F.coalesce("_carry", zero)
    return (
        local.join(carried, [*account, "_seg"], "left")
        .withColumns({"known": known, "balance": balance, "amt": -F.col("delta")})
        .where("side = 0 AND (known = 0 OR balance < amt)")
        .withColumn("known", F.col("known") > 0)
        .select("chain_id", "pos", "idx", F.col("account").alias("send"), "amt", "balance", "known")
    )


def bad_rewards(blocks: DataFrame, txs: DataFrame) -> DataFrame:
    """The last amount of each block is its reward; a block without transactions takes the amount before it."""
    last = txs.groupBy("chain_id", "pos").agg(F.max_by("amt", "idx").alias("_amt"))
    amounts = blocks.select("chain_id", "pos").join(last, ["chain_id", "pos"], "left")
    numbered = amounts.select("chain_id", "pos", fn.whole_number(F.col("_amt")).alias("_amt"))
    ordered = _before(numbered, ["chain_id"], ["pos"], "_amt")
    paid = F.coalesce("_amt", "before", F.lit(fn.FIRST_REWARD)).alias("paid")
    checked = ordered.select("chain_id", "pos", paid, fn.reward_at(F.col("pos")).alias("due"))
    return checked.where("paid <> due")


def bad_tx_hashes(txs: DataFrame) -> DataFrame:
    """The hash is the one of the fields."""
    return txs.where(_tx_hash_broken()).select("chain_id", "pos", "idx", "hash")


def with_previous_hash(blocks: DataFrame) -> DataFrame:
    """Add the hash of the block before, by a join on the position: positions have no gaps."""
    before = blocks.select("chain_id", (F.col("pos") + 1).alias("pos"), F.col("hash").alias("_prev"))
    joined = blocks.join(before, ["chain_id", "pos"], "left")
    previous = F.when(F.col("id") == 0, F.lit(fn.GENESIS_HASH)).otherwise(F.coalesce("_prev", F.lit("")))
    return joined.withColumn("prev_hash", previous).drop("_prev")


def bad_block_hashes(blocks: DataFrame) -> DataFrame:
    """The hash is the one of the id, the previous hash, the transaction hashes and the proof of work."""
    return with_previous_hash(blocks).where(_block_hash_broken()).select("chain_id", "pos", "hash")


def bad_targets(blocks: DataFrame) -> DataFrame:
    """The hash is not above the target in text order; equality passes."""
    return blocks.where(_target_broken()).select("chain_id", "pos", "hash", "target")


def bad_signatures(txs: DataFrame, modulus: int = fn.SIGNATURE_MODULUS) -> DataFrame:
    """Signed transactions whose signature does not give their hash."""
    signed = txs.where("sig IS NOT NULL AND hash IS NOT NULL AND hash <> ''")
    holds = fn.signature_holds(F.col("sig"), F.col("send"), F.col("hash"), modulus)
    return signed.where(~holds).select("chain_id", "pos", "idx", "hash", "sig")


def invalid_chains(blocks: DataFrame, txs: DataFrame, modulus: int = fn.SIGNATURE_MODULUS) -> DataFrame:
    """Chains with a violation.

    The rules that look at single rows share a scan each of blocks and transactions; the others have their own.
    Violations combine to one row per chain and task before the shuffle.
    """
    found = [
        with_previous_hash(blocks).where(_id_broken() | _target_broken() | _block_hash_broken()),
        txs.where(_amount_broken() | _tx_hash_broken()),
        bad_signatures(txs, modulus),
        bad_times(txs),
        bad_balances(txs),
        bad_rewards(blocks, txs),
    ]
    return reduce(DataFrame.unionByName, [bad.select("chain_id") for bad in found]).distinct()


def verdicts(chains: DataFrame, invalid: DataFrame) -> DataFrame:
    """Each chain with whether it is valid, that is, not among the invalid ones."""
    marked = invalid.distinct().withColumn("_bad", F.lit(True))
    joined = chains.select("chain_id").distinct().join(marked, "chain_id", "left")
    return joined.select("chain_id", F.col("_bad").isNull().alias("valid"))
