"""Fixed schemas of the files and payloads the engine reads."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_L, _S, _I = LongType(), StringType(), IntegerType()

AUTHOR = _struct(id=_L, id_str=_S, screen_name=_S, description=_S, followers_count=_L)

RAW_POST = _struct(
    id=_L,
    id_str=_S,
    created_at=_S,
    text=_S,
    lang=_S,
    in_reply_to_user_id=_L,
    in_reply_to_user_id_str=_S,
    favorite_count=_L,
    retweet_count=_L,
    user=AUTHOR,
    retweeted_status=_struct(user=_struct(id=_L, id_str=_S, screen_name=_S, description=_S)),
    entities=_struct(hashtags=ArrayType(_struct(text=_S, indices=ArrayType(_L)))),
)

POST = _struct(
    tid=_L, timestamp=_L, content=_S, reply_to_uid=_L, sender_uid=_L, retweet_to_uid=_L, hashtags=_S, lang=_S
)

PROFILE = _struct(uid=_L, screen_name=_S, description=_S, timestamp=_L)

TOPIC_POST = _struct(
    tid=_L, sender_uid=_L, content=_S, timestamp=_L, followers_count=_I, favorite_count=_I, retweet_count=_I
)

USER_TAGS = _struct(sender_uid=_L, hashtags=_S)

# Amounts and fees stay text: the transaction hash is taken over their digits.
LEDGER_TX = _struct(time=_S, send=_L, recv=_L, amt=_S, fee=_S, hash=_S, sig=_L)

LEDGER = _struct(
    chain=ArrayType(_struct(id=_I, hash=_S, pow=_S, target=_S, all_tx=ArrayType(LEDGER_TX))),
    new_tx=ArrayType(LEDGER_TX),
    new_target=_S,
)
