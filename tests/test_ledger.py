import base64
import hashlib
import json
import random
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from starling.functions import ledger as fn
from starling.operators import ledger as ops
from starling.plans.ledger import ledger_report
from starling.sources.payloads import decode_payload

# A small key pair made for these tests: the user number is the public exponent.
P, Q = 1000003, 1000033
MODULUS = P * Q
PUBLIC = 65537
PRIVATE = pow(PUBLIC, -1, (P - 1) * (Q - 1))
MINER = 11


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tx(time, recv, amt, send=None, fee=None):
    fields = [time, "" if send is None else send, recv, amt, "" if fee is None else fee]
    made = {"time": str(time), "recv": recv, "amt": amt, "hash": sha("|".join(map(str, fields)))[:8]}
    if send is not None:
        made |= {"send": send, "fee": fee, "sig": pow(int(made["hash"], 16) % MODULUS, PRIVATE, MODULUS)}
    return made


def chain(*blocks, target="ffffffff"):
    made, prev = [], "00000000"
    for i, txs in enumerate(blocks):
        info = "|".join([str(i), prev, *(t["hash"] for t in txs)])
        prev = sha(sha(info) + f"p{i}")[:8]
        made.append({"id": i, "hash": prev, "pow": f"p{i}", "target": target, "all_tx": list(txs)})
    return {"chain": made, "new_tx": [], "new_target": "0"}


def pack(ledger):
    return base64.urlsafe_b64encode(zlib.compress(json.dumps(ledger).encode())).decode().rstrip("=")


@pytest.fixture
def audit(spark):
    def run(*ledgers):
        df = spark.createDataFrame([(i, 0, pack(x)) for i, x in enumerate(ledgers)], "chain_id int, part int, payload string")
        blocks, txs = ops.explode_ledger(decode_payload(df))
        checks = {
            "ids": ops.bad_ids(blocks),
            "amounts": ops.bad_amounts(txs),
            "times": ops.bad_times(txs),
            "balance": ops.bad_balances(txs),
            "rewards": ops.bad_rewards(blocks, txs),
            "tx_hash": ops.bad_tx_hashes(txs),
            "block_hash": ops.bad_block_hashes(blocks),
            "target": ops.bad_targets(blocks),
            "signature": ops.bad_signatures(txs, MODULUS),
        }
        found = {name: {r.chain_id for r in bad.collect()} for name, bad in checks.items()}
        invalid = {r.chain_id for r in ops.invalid_chains(blocks, txs, MODULUS).collect()}
        assert invalid == set().union(*found.values())
        return [{name for name, chains in found.items() if i in chains} for i in range(len(ledgers))]

    return run


def test_valid_chain(audit):
    assert audit(chain([tx(1, MINER, 500000000)], [], [tx(2, MINER, 250000000)])) == [set()]


def test_empty_chain_is_valid(audit):
    assert audit(chain()) == [set()]


def test_block_without_transactions_inherits_the_amount(audit):
    assert audit(chain([tx(1, MINER, 500000000)], [])) == [set()]
    broken = chain([tx(1, MINER, 500000000)], [tx(2, MINER, 500000000)], [])
    assert audit(broken) == [{"rewards"}]


def test_signed_transfer(audit):
    first = tx(1, PUBLIC, 500000000)
    pay = tx(2, 5, 500000000, send=PUBLIC, fee=3)
    assert audit(chain([first], [pay])) == [set()]
    forged = dict(pay, sig=pay["sig"] + 1)
    assert audit(chain([first], [forged])) == [{"signature"}]


def test_each_rule(audit):
    def one(t, **change):
        return chain([dict(t, **change)])

    reward = tx(5, MINER, 500000000)
    above = chain([reward], target="00000000")
    equal = chain([reward])
    equal["chain"][0]["target"] = equal["chain"][0]["hash"]
    skipped = chain([reward])
    skipped["chain"][0]["id"] = 1
    negative_fee = chain([reward, tx(6, 2, 500000000, send=MINER, fee=-1)])
    del negative_fee["chain"][0]["all_tx"][1]["sig"]
    fraction = one(reward, amt=500000000.5)
    assert audit(above, equal, skipped, negative_fee, fraction) == [
        {"target"},
        set(),
        {"ids", "block_hash"},
        {"amounts"},
        {"tx_hash"},
    ]


def test_time_order_crosses_blocks_and_empty_blocks(audit):
    late = chain([tx(9, MINER, 500000000)], [], [tx(8, MINER, 250000000)])
    assert audit(late) == [{"times"}]
    assert audit(chain([tx(-1, MINER, 500000000)])) == [{"times"}]
    assert audit(chain([tx(9, MINER, 500000000)], [tx(9, MINER, 500000000)])) == [set()]


def unsigned(*args, **kwargs):
    made = tx(*args, **kwargs)
    made.pop("sig", None)
    return made


def test_balance(audit):
    start = tx(1, 1, 500000000)
    exact = unsigned(2, 2, 500000000, send=1)
    assert audit(chain([start, exact])) == [set()]
    assert audit(chain([start, unsigned(2, 2, 500000000, send=3)])) == [{"balance"}]
    assert audit(chain([start, unsigned(2, 1, 500000000, send=1)])) == [set()]
    assert audit(chain([unsigned(1, 2, 0, send=3), tx(2, 2, 500000000)])) == [{"balance"}]
    assert audit(chain([start, exact, unsigned(3, 2, 500000000, send=1)])) == [{"balance"}]


def test_damaged_payload_is_invalid(spark, rows):
    df = spark.createDataFrame(
        [(1, 0, "zzzz"), (2, 0, pack(chain([tx(1, MINER, 500000000)]))), (3, 0, None)], "chain_id int, part int, payload string"
    )
    assert rows(ledger_report(df)) == [(1, False), (2, True), (3, False)]


def test_payload_padding_and_alphabet(spark):
    ledger = chain([tx(1, MINER, 500000000)])
    plain = base64.b64encode(zlib.compress(json.dumps(ledger).encode())).decode()
    df = spark.createDataFrame([(plain,), (pack(ledger),)], "payload string")
    got = decode_payload(df).select(F.col("ledger.chain")[0]["hash"]).collect()
    assert [r[0] for r in got] == [ledger["chain"][0]["hash"]] * 2


def test_large_payload_is_read_whole(spark):
    ledger = chain([tx(i, random.Random(i).randrange(10**9), 500000000) for i in range(3000)])
    df = spark.createDataFrame([(1, 0, pack(ledger))], "chain_id int, part int, payload string")
    assert ops.explode_ledger(decode_payload(df))[1].count() == 3000


@pytest.mark.parametrize("segment", [1, 3, 1000])
def test_segments_give_the_rows_of_one_pass(spark, rows, monkeypatch, segment):
    """A chain cut into segments is audited as one sequence; one account holds much of it."""
    monkeypatch.setattr(ops, "SEGMENT_BLOCKS", segment)
    rng = random.Random(4)
    txs, time = [], 0
    for pos in range(40):
        for idx in range(rng.randrange(0, 5)):
            time += rng.choice([0, 1, 5, -1])
            send = rng.choice([None, 1, 1, 2, 3])
            txs.append((1, pos, idx, str(time), send, rng.choice([1, 1, 2]), str(rng.randrange(0, 30))))
    frame = spark.createDataFrame(
        txs, "chain_id int, pos long, idx long, time string, send long, recv long, amt string"
    )
    blocks = spark.createDataFrame([(1, p) for p in range(40)], "chain_id int, pos long")
    late, previous = [], 0
    held, seen, over = {}, set(), []
    last_amount, paid = ops.fn.FIRST_REWARD, {}
    for _, pos, idx, at, send, recv, amt in txs:
        if int(at) < previous:
            late.append((pos, idx))
        previous = int(at)
        if send is not None:
            if send not in seen or held.get(send, 0) < int(amt):
                over.append((pos, idx))
            seen.add(send)
            held[send] = held.get(send, 0) - int(amt)
        seen.add(recv)
        held[recv] = held.get(recv, 0) + int(amt)
        paid[pos] = int(amt)
    wrong = []
    for pos in range(40):
        last_amount = paid.get(pos, last_amount)
        if last_amount != ops.fn.FIRST_REWARD >> (pos // 2):
            wrong.append((pos,))
    assert rows(ops.bad_times(frame), "pos", "idx") == sorted(late, key=repr)
    assert rows(ops.bad_balances(frame), "pos", "idx") == sorted(over, key=repr)
    assert rows(ops.bad_rewards(blocks, frame), "pos") == sorted(wrong, key=repr)


def test_powers_equal_those_of_whole_numbers(spark):
    rand = random.Random(9)
    rows = [(0, 0), (5, 0), (0, 5), (7, 1), (1, (1 << 62) + 3), (-3, 7), ((1 << 62) + 1, (1 << 41) - 1), (2, -1), (None, 3), (3, None)]
    rows += [(rand.randrange(1 << 62), rand.randrange(1 << rand.randrange(1, 62))) for _ in range(300)]
    table = spark.createDataFrame(rows, "base long, exponent long")
    for modulus in (fn.SIGNATURE_MODULUS, MODULUS, 1, 2, (1 << 62) + 57):
        found = table.select("base", "exponent", fn.power_mod(F.col("base"), F.col("exponent"), modulus).alias("power"))
        for row in found.collect():
            known = row.base is not None and row.exponent is not None and row.exponent >= 0
            assert row.power == (pow(row.base, row.exponent, modulus) if known else None), row


def test_signatures_of_real_keys(spark):
    rows = []
    for i, text in enumerate(["00000000", "0000abcd", "deadbeef", "ffffffff", "12"]):
        number = int(text, 16) % MODULUS
        if number == int(text, 16):
            rows.append((i, text, pow(number, PRIVATE, MODULUS)))
    table = spark.createDataFrame([(i, t, s, PUBLIC) for i, t, s in rows], "i int, hash string, sig long, send long")
    holds = fn.signature_holds(F.col("sig"), F.col("send"), F.col("hash"), MODULUS)
    assert [r[0] for r in table.select(holds).collect()] == [True] * len(rows)
    forged = table.select(fn.signature_holds(F.col("sig") + 1, F.col("send"), F.col("hash"), MODULUS))
    assert not any(r[0] for r in forged.collect())
    odd = [("xyz", 1, 1), ("", 1, 1), (None, 1, 1), ("1", None, 1), ("1", 1, None)]
    odd = spark.createDataFrame(odd, "hash string, sig long, send long")
    assert not any(r[0] for r in odd.select(fn.signature_holds(F.col("sig"), F.col("send"), F.col("hash"))).collect())


def test_signatures_are_checked_without_python(spark):
    txs = spark.createDataFrame([(1, 0, 0, "ab", 3, 2)], "chain_id long, pos long, idx long, hash string, sig long, send long")
    plan = ops.bad_signatures(txs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_text_is_handed_on_in_pieces():
    """Many rows in one batch of payloads do not make one batch of text."""
    streams = [zlib.compress(b"x" * 300_000), None, b"damaged", zlib.compress(b"\xff"), zlib.compress(b"")] * 40
    pieces = list(fn._inflate.func(iter([pa.array(streams, pa.binary()), pa.array([], pa.binary())])))
    assert [t for p in pieces for t in p.to_pylist()] == ["x" * 300_000, None, None, None, ""] * 40
    assert max(p.nbytes for p in pieces) < 2 * fn.PIECE_CHARS


def test_payloads_are_made_and_inflated_once(spark, tmp_path):
    """Neither the padding nor the filter on empty chains repeats what the payload comes from."""
    events = spark.sql("SELECT id AS event_id, TIMESTAMP_SECONDS(id) AS ts, id % 7 AS user_id, 'view' AS event_type, 1.5D AS value FROM range(99)")
    events.write.parquet(str(tmp_path / "events.parquet"))
    plan = entry.queries()["ledger_explode"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2 and "pythonUDF1" not in plan
