"""The given star schema seen as the engine's tables."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from functools import cached_property
from typing import Any, TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from starling.functions import ledger as fn
from starling.operators.dedup import dedup_posts
from starling.operators.summaries import Summaries, summarize, summarize_sizes
from starling.plans import ingest, serving
from starling.plans.combined import combined
from starling.session import is_stored, materialize, scratch_path, small_table
from starling.sources.files import term_list

# Term lists and requests of the workload.
POPULAR = ("economy", "ring")
STOP = ("the", "and", "of", "to", "in", "http", "as")
BANNED = ("widget", "that", "on", "with")
CONTACT_REQUESTS = (
    (1, 5, "reply", "ring", "ring"),
    (2, 7, "retweet", "HIGH", "Brand1_"),
    (3, 42, "both", "blue", "economy"),
    (4, 1200, "both", "", "small"),
    (5, 99999, "both", "x", "y"),
)
TOPIC_REQUESTS = (
    (1, 0, 96, 1700000000, 1700002000, 10, 5),
    (2, 10, 40, 1700000000, 1700099999, 3, 20),
    (3, 50, 40, 1700000000, 1700099999, 3, 3),
)
BLOCKS_PER_PAYLOAD = 4

T = TypeVar("T")
_STORED: dict[tuple[str, str, str], tuple[str, Any]] = {}


def epoch(column: str) -> Column:
    return F.unix_seconds(F.col(column).cast("timestamp"))


@F.arrow_udf(StringType())
def _pack(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        packed = (base64.urlsafe_b64encode(zlib.compress(t.as_py().encode())).decode().rstrip("=") for t in batch)
        yield pa.array(packed, pa.string())


class Tables:
    """Frames over the parquet files of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        # The files carry times without a zone; they are read as UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def posts_raw(self) -> DataFrame:
        """Line items as posts, with duplicated ids."""
        orders, part = self.read("orders"), self.read("part")
        joined = (
            self.read("lineitem")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
        )
        flag = F.col("l_returnflag")
        tags = F.concat(
            F.replace(F.col("p_brand"), F.lit("#"), F.lit("")),
            F.lit("_"),
            F.col("p_size").cast("string"),
            F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit(","), "p_type")).otherwise(""),
            F.when(
                F.col("p_partkey") % 7 == 0, F.concat(F.lit(","), F.replace(F.col("p_name"), F.lit(" "), F.lit(",")))
            ).otherwise(""),
        )
        return joined.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("tid"),
            epoch("l_shipdate").alias("timestamp"),
            F.concat_ws(" ", "p_name", F.lower("p_type"), "o_orderpriority").alias("content"),
            F.when(flag == "A", F.col("l_suppkey")).alias("reply_to_uid"),
            F.col("o_custkey").alias("sender_uid"),
            F.when(flag == "R", F.col("l_suppkey")).alias("retweet_to_uid"),
            tags.alias("hashtags"),
            F.when(F.col("l_linestatus") == "O", "en").otherwise("fr").alias("lang"),
        )

    @cached_property
    def posts(self) -> DataFrame:
        return dedup_posts(self.posts_raw)

    @cached_property
    def stored_posts(self) -> DataFrame:
        """The same, written once for plans that read them several times."""
        return materialize(self.posts, "posts")

    @cached_property
    def user_mid(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_custkey").alias("uid"),
            F.col("o_orderpriority").alias("screen_name"),
            F.col("o_orderstatus").alias("description"),
            epoch("o_orderdate").alias("timestamp"),
        )

    @cached_property
    def users(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("uid"),
            F.col("c_name").alias("screen_name"),
            F.col("c_mktsegment").alias("description"),
        )

    @cached_property
    def topic_posts(self) -> DataFrame:
        docs = self.read("documents")
        pages = self.read("pages").select(F.col("page_id").alias("doc_id"), "url")
        joined = docs.join(pages, "doc_id", "left").join(self.read("labels"), "doc_id", "left")
        return joined.select(
            F.col("doc_id").alias("tid"),
            (F.col("doc_id") % 97).alias("sender_uid"),
            F.concat("text", F.lit(" "), F.coalesce("url", F.lit(""))).alias("content"),
            (F.col("n_chars") + 1700000000).alias("timestamp"),
            (F.col("n_chars") % 1000).alias("followers_count"),
            F.col("quality").alias("favorite_count"),
            F.col("toxic").alias("retweet_count"),
            "lang",
        )

    def stored(self, name: str, build: Callable[[], tuple[str, T]]) -> T:
        """What `build` has stored in a folder, once for an application and tables: later queries answer from it."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _STORED or not is_stored(self.spark, _STORED[key][0]):
            _STORED[key] = build()
        return _STORED[key][1]

    @property
    def topic_summaries(self) -> Summaries:
        def build():
            found = summarize(self.topic_posts, self.stop)
            return found.index.inputFiles()[0] if found.index.inputFiles() else "", found

        return self.stored("summaries", build)

    @property
    def topic_sums(self) -> Summaries:
        """The same without an index of terms."""

        def build():
            found = summarize(self.topic_posts, self.stop, with_index=False)
            return found.words.inputFiles()[0] if found.words.inputFiles() else "", found

        return self.stored("sums", build)

    @property
    def topic_sizes(self) -> Summaries:
        """The numbers of posts alone."""

        def build():
            found = summarize_sizes(self.topic_posts)
            return found.sizes.inputFiles()[0] if found.sizes.inputFiles() else "", found

        return self.stored("sizes", build)

    @property
    def serving(self) -> str:
        """The folder of the tables that answer the requests, laid out by user: those of the asked users."""

        def build():
            path = scratch_path(self.spark, "serving")
            serving.write(self.stored_posts, self.users, self.popular, path, docs=False, uids=self.contact_requests)
            return path, path

        return self.stored("serving", build)

    def docs_of(self, uid: int) -> DataFrame:
        """The combined table of one user, from the posts of its pairs."""
        uids = small_table(self.spark, [(uid,)], uid=pa.int64())
        between = materialize(serving.posts_between(self.stored_posts, uids), "between")
        return combined(between, self.users, self.popular, every=self.stored_posts).where(F.col("uid") == uid)

    @cached_property
    def raw(self) -> DataFrame:
        """Posts as nested raw posts, with the gaps and faults raw data has."""
        p = self.posts_raw
        tid, sender, reply, share = (F.col(c) for c in ("tid", "sender_uid", "reply_to_uid", "retweet_to_uid"))
        seconds = F.timestamp_seconds(F.col("timestamp") + tid % 86400)

        def name(uid: Column) -> Column:
            return F.concat(F.lit("user"), uid.cast("string"))

        def about(uid: Column) -> Column:
            return F.concat(F.lit("writes "), F.col("lang"), F.lit(" "), (uid % 7).cast("string"))

        created = F.date_format(seconds, "'Fri' MMM dd HH:mm:ss '+0000' yyyy")
        tid_text = F.when(tid % 11 == 0, None).when(
            (tid % 13 == 0) & (tid % 7 != 0), F.concat(F.lit("x"), tid.cast("string"))
        )
        author = F.struct(
            F.when(tid % 31 != 0, sender).alias("id"),
            F.when(tid % 3 != 0, sender.cast("string")).alias("id_str"),
            name(sender).alias("screen_name"),
            about(sender).alias("description"),
            (tid % 1000).alias("followers_count"),
        )
        origin = F.struct(
            share.alias("id"),
            share.cast("string").alias("id_str"),
            name(share).alias("screen_name"),
            about(share).alias("description"),
        )
        tags = F.transform(
            F.split("hashtags", ","),
            lambda t: F.struct(t.alias("text"), F.array(F.lit(0), F.length(t)).cast("array<bigint>").alias("indices")),
        )
        return p.select(
            F.when(tid % 7 != 0, tid).alias("id"),
            tid_text.otherwise(tid.cast("string")).alias("id_str"),
            F.when(tid % 17 == 0, "some day").otherwise(created).alias("created_at"),
            F.when(tid % 19 == 0, None).when(tid % 23 == 0, "").otherwise(F.col("content")).alias("text"),
            F.when(tid % 29 == 0, "de").otherwise(F.col("lang")).alias("lang"),
            reply.alias("in_reply_to_user_id"),
            reply.cast("string").alias("in_reply_to_user_id_str"),
            (tid % 50).alias("favorite_count"),
            F.when(tid % 5 != 0, tid % 20).alias("retweet_count"),
            author.alias("user"),
            F.when(share.isNotNull(), F.struct(origin.alias("user"))).alias("retweeted_status"),
            F.when(tid % 37 != 0, F.struct(tags.alias("hashtags"))).alias("entities"),
        )

    @cached_property
    def clean_rows(self) -> DataFrame:
        return ingest.clean_rows(self.raw)

    @cached_property
    def popular(self) -> DataFrame:
        return self.terms(POPULAR)

    def terms(self, values: tuple[str, ...]) -> DataFrame:
        return small_table(self.spark, [(v,) for v in values], term=pa.string())

    @cached_property
    def stop(self) -> list[str]:
        return term_list(self.terms(STOP))

    @cached_property
    def banned(self) -> list[str]:
        return term_list(self.terms(BANNED))

    @cached_property
    def contact_requests(self) -> DataFrame:
        text = {c: pa.string() for c in ("type", "phrase", "hashtag")}
        return small_table(self.spark, CONTACT_REQUESTS, request_id=pa.int32(), uid=pa.int64(), **text)

    @cached_property
    def topic_requests(self) -> DataFrame:
        bounds = {c: pa.int64() for c in ("uid_start", "uid_end", "time_start", "time_end")}
        return small_table(
            self.spark, TOPIC_REQUESTS, request_id=pa.int32(), **bounds, n1=pa.int32(), n2=pa.int32()
        )

    @cached_property
    def ledger_txs(self) -> DataFrame:
        """Events as transactions: one long chain per user, and short chains of rewards for every fifth user."""
        numbered = self.read("events").withColumn(
            "rn", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
        )
        event, user, rn = F.col("event_id"), F.col("user_id"), F.col("rn")
        index = ((rn - 1) % 5).cast("bigint").alias("idx")
        block = F.floor((rn - 1) / 5).cast("bigint")
        long_chains = numbered.select(
            event.alias("event_id"),
            user.alias("chain_id"),
            block.alias("pos"),
            index,
            (epoch("ts") - F.when(event % 97 == 0, 1000000).otherwise(0)).cast("string").alias("time"),
            F.when(F.col("event_type") == "purchase", event % 3).alias("send"),
            (event % 4).alias("recv"),
            F.round(F.col("value") * 100).cast("bigint").alias("amount"),
            F.when(event % 3 == 0, event % 11 - 1).alias("fee_value"),
        )
        short_chains = numbered.where(user % 5 == 0).select(
            event.alias("event_id"),
            (F.lit(1000000).cast("bigint") + user * 1000 + block).alias("chain_id"),
            F.lit(0).cast("bigint").alias("pos"),
            index,
            epoch("ts").cast("string").alias("time"),
            F.lit(None).cast("bigint").alias("send"),
            (event % 4).alias("recv"),
            F.when(event % 41 == 0, 1).otherwise(fn.FIRST_REWARD).cast("bigint").alias("amount"),
            F.lit(None).cast("bigint").alias("fee_value"),
        )
        txs = long_chains.unionByName(short_chains).select(
            "*", F.col("amount").cast("string").alias("amt"), F.col("fee_value").cast("string").alias("fee")
        )
        true_hash = fn.tx_hash(*(F.col(c) for c in ("time", "send", "recv", "amt", "fee")))
        hashed = txs.withColumn("hash", F.when(event % 50 == 0, "deadbeef").otherwise(true_hash))
        signed = F.when((event % 4 == 0) & F.col("send").isNotNull(), F.conv("hash", 16, 10).cast("bigint"))
        return hashed.withColumn("sig", signed).select(
            "chain_id", "pos", "idx", "time", "send", "recv", "amt", "fee", "hash", "sig"
        )

    @cached_property
    def ledger_blocks(self) -> DataFrame:
        """Blocks of at most five transactions; every second block of a chain holds the hash the rule asks for."""
        listed = F.array_sort(F.collect_list(F.struct("idx", "hash")))
        blocks = self.ledger_txs.groupBy("chain_id", "pos").agg(listed.alias("txs"))
        chain, pos = F.col("chain_id"), F.col("pos")

        def stand_in(at: Column) -> Column:
            return fn.short_hash(F.concat_ws("|", chain.cast("string"), at.cast("string")))

        block_id = F.when((chain + pos) % 23 == 0, pos + 1).otherwise(pos).cast("int")
        prev = F.when(pos == 0, fn.GENESIS_HASH).otherwise(stand_in(pos - 1))
        fields = blocks.select(
            "chain_id",
            "pos",
            block_id.alias("id"),
            pos.cast("string").alias("pow"),
            F.when((chain + pos) % 4 == 0, "80000000").otherwise("ffffffff").alias("target"),
            F.col("txs.hash").alias("tx_hashes"),
            prev.alias("prev"),
        )
        due = fn.block_hash(F.col("id"), F.col("prev"), F.col("tx_hashes"), F.col("pow"))
        stated = F.when(pos % 2 == 1, stand_in(pos)).when(chain % 9 == 0, "00000001").otherwise(due)
        return fields.withColumn("hash", stated).select("chain_id", "pos", "id", "hash", "pow", "target", "tx_hashes")

    @cached_property
    def payloads(self) -> DataFrame:
        """Chains as encoded payloads of a few blocks each."""
        tx = F.struct(
            "idx",
            "time",
            "send",
            "recv",
            F.col("amt").cast("bigint").alias("amt"),
            F.col("fee").cast("bigint").alias("fee"),
            "hash",
            "sig",
        )
        txs = self.ledger_txs.groupBy("chain_id", "pos").agg(F.array_sort(F.collect_list(tx)).alias("all_tx"))
        full = self.ledger_blocks.drop("tx_hashes").join(txs, ["chain_id", "pos"])
        block = F.struct("pos", "id", "hash", "pow", "target", "all_tx")
        part = F.floor(F.col("pos") / BLOCKS_PER_PAYLOAD).cast("int")
        grouped = full.groupBy("chain_id", part.alias("part")).agg(F.array_sort(F.collect_list(block)).alias("chain"))
        body = F.to_json(F.struct("chain", F.array().alias("new_tx"), F.lit("").alias("new_target")))
        return grouped.select("chain_id", "part", _pack(body).alias("payload"))


