"""Hash and signature expressions of the ledger."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed values of the ledger rules.
FIRST_REWARD = 500_000_000
GENESIS_HASH = "00000000"
HASH_CHARS = 8
SIGNATURE_MODULUS = 1561906343821

# Inflated text that a Python worker holds before it hands it on.
PIECE_CHARS = 1 << 20


def short_hash(text: Column) -> Column:
    return F.left(F.sha2(text, 256), F.lit(HASH_CHARS))


def tx_hash(time: Column, send: Column, recv: Column, amt: Column, fee: Column) -> Column:
    """Hash over time|send|recv|amt|fee, missing fields as empty text."""
    fields = [F.coalesce(c.cast("string"), F.lit("")) for c in (time, send, recv, amt, fee)]
    return short_hash(F.concat_ws("|", *fields))


def block_hash(block_id: Column, previous: Column, tx_hashes: Column, pow_text: Column) -> Column:
    """Hash over the digest of id|previous|tx hashes followed by the proof of work."""
    head = [block_id.cast("string"), previous]
    info = F.array_join(F.concat(F.array(*head), tx_hashes), "|")
    return short_hash(F.concat(F.sha2(info, 256), F.coalesce(pow_text, F.lit(""))))


def reward_at(position: Column) -> Column:
    """The reward halves every second block."""
    return F.call_function(
        "shiftright", F.lit(FIRST_REWARD).cast("bigint"), F.least(F.floor(position / 2), F.lit(62)).cast("int")
    )


def whole_number(text: Column) -> Column:
    """Number text as a whole number, fractions cut off; null where it is no number."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,10)").try_cast("bigint"))


@F.arrow_udf(StringType())
def _inflate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    def one(data):
        try:
            return None if data is None else zlib.decompress(data).decode("utf-8")
        except (zlib.error, UnicodeDecodeError):
            return None

    # A piece of text goes on when it is large enough, whatever the number of rows of a batch.
    for batch in batches:
        texts, size = [], 0
        for data in batch:
            texts.append(one(data.as_py()))
            size += len(texts[-1] or "")
            if size >= PIECE_CHARS:
                yield pa.array(texts, pa.string())
                texts, size = [], 0
        if texts:
            yield pa.array(texts, pa.string())


def inflate(payload: Column) -> Column:
    """Text of a zlib stream in base64, either alphabet, with or without padding; null where damaged."""
    plain = F.translate(F.rtrim(payload), "-_=", "+/")
    # The payload is named once: what it is made of would else be made as often as it is named.
    padded = F.transform(F.array(plain), lambda p: F.rpad(p, F.ceil(F.length(p) / 4).cast("int") * 4, F.lit("=")))[0]
    return _inflate(F.try_to_binary(padded, F.lit("base64")))


def power_mod(base: Column, exponent: Column, modulus: int = SIGNATURE_MODULUS) -> Column:
    """base to the power of a whole number from 0 on, modulo the modulus (below 2**63); null for a negative exponent.

    Squares and multiplies along the bits of the exponent, in decimals of 38 digits, which hold the product of two
    remainders.
    """
    kind = "decimal(38,0)"
    whole = F.lit(modulus).cast(kind)

    def reduced(product: Column) -> Column:
        return (product % whole).cast(kind)

    start = F.pmod(base.cast("bigint"), F.lit(modulus)).cast(kind)

    def step(power: Column, bit: Column) -> Column:
        square = reduced(power * power)
        return F.when(bit == "1", reduced(square * start)).otherwise(square)

    bits = F.split(F.bin(exponent.cast("bigint")), "")
    return F.when(exponent >= 0, F.aggregate(bits, reduced(F.lit(1).cast(kind)), step).cast("bigint"))


def signature_holds(sig: Column, send: Column, tx_hash_text: Column, modulus: int = SIGNATURE_MODULUS) -> Column:
    """Whether sig to the power of send, modulo the modulus, is the hash as a hexadecimal number; no for no sender.

    A negative sender signs nothing.
    """
    due = F.lower(F.regexp_replace(tx_hash_text, "^0+(?=.)", ""))
    made = F.lower(F.hex(power_mod(sig, send, modulus)))
    return F.coalesce(made == due, F.lit(False))
