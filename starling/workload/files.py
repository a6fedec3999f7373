"""Queries: readers and writers, as round trips through fresh folders of the shared scratch space."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from starling.operators.graph import interactions
from starling.plans import ingest
from starling.schemas import POST, USER_TAGS
from starling.session import scratch_path, small_table
from starling.sinks import files as sinks
from starling.sources import files as sources
from starling.workload.registry import query
from starling.workload.views import POST_COLUMNS

_POSTS = f"SELECT {POST_COLUMNS} FROM posts_raw"
# Text with the characters a delimited file has to survive.
_ODD = "concat(content, CASE WHEN tid % 3 = 0 THEN concat(', \"x\"', chr(10), 'y') ELSE '' END)"
_ODD_POSTS = f"SELECT tid, timestamp, {_ODD} AS content, reply_to_uid, sender_uid, retweet_to_uid, hashtags, lang FROM posts_raw"


def _odd_posts(t):
    odd = F.concat("content", F.when(F.col("tid") % 3 == 0, ', "x"\ny').otherwise(""))
    return t.posts_raw.withColumn("content", odd)


def _json(t):
    path = scratch_path(t.spark, "raw")
    # Read once and soon after: the cheapest level of compression is enough.
    options = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    t.raw.write.options(**options).json(path)
    damaged = t.read("region").select(F.concat(F.lit("{not json "), "r_name").alias("value"))
    damaged.write.mode("append").options(**options).text(path)
    return sources.read_posts(t.spark, path)


_TOPIC_FIELDS = """tid, tid_str, timestamp, content, sender_uid, sender_uid_str, followers_count, favorite_count,
  retweet_count, lang"""
# Damaged lines, one per region, are rows of nulls.
query(
    "scan_posts_json",
    f"""SELECT {_TOPIC_FIELDS} FROM picked
  UNION ALL SELECT {", ".join(["NULL"] * len(_TOPIC_FIELDS.split(",")))} FROM region""",
)(lambda t: ingest.clean.project_topic_posts(_json(t)))
query("q_clean_posts", f"SELECT {POST_COLUMNS} FROM clean")(lambda t: ingest.clean_posts(_json(t)))


def _delimited(t, header=True, schema=POST):
    path = scratch_path(t.spark, "posts")
    sinks.write_delimited(_odd_posts(t), path, header)
    return sources.read_delimited(t.spark, path, schema, header)


query("scan_delimited", _ODD_POSTS)(lambda t: _delimited(t))
query("sink_delimited", _ODD_POSTS)(lambda t: _delimited(t, header=False))


def _inferred(t):
    path = scratch_path(t.spark, "users")
    sinks.write_delimited(t.user_mid, path)
    read = sources.read_delimited(t.spark, path)
    return read.select(F.col("uid").cast("bigint").alias("uid"), "screen_name", "description", F.col("timestamp").cast("bigint").alias("timestamp"))


query("scan_delimited_infer", "SELECT uid, screen_name, description, timestamp FROM user_mid")(_inferred)


def _terms(t):
    path = scratch_path(t.spark, "terms")
    names = t.read("part").select(F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")))
    names.write.text(path)
    return sources.read_terms(t.spark, path)


query("scan_wordlist", "SELECT DISTINCT lower(p_name) AS term FROM part")(_terms)


def _quoted(t):
    path = scratch_path(t.spark, "quoted")
    sinks.export_csv(t.users, path)
    # Every field is quoted, so a line holds twice as many quotes as fields, and more only for quotes inside.
    return t.spark.read.text(path).select(F.col("value").alias("line"))


query(
    "sink_export_quoted",
    """SELECT concat('"', uid, '","', screen_name, '","', description, '"') AS line FROM users""",
)(_quoted)


def _loaded(t):
    path, table = scratch_path(t.spark, "load"), f"starling_{uuid.uuid4().hex}"
    pairs = t.posts_raw.select("sender_uid", "hashtags")
    sinks.write_delimited(pairs, path, header=False)
    sinks.load_delimited(t.spark, path, table, USER_TAGS, location=scratch_path(t.spark, "table"))
    return t.spark.table(table)


query("load_delimited_table", "SELECT sender_uid, hashtags FROM posts_raw")(_loaded)


def _loaded_again(t):
    """Half of the rows, then the whole folder, twice."""
    path, location = scratch_path(t.spark, "load"), scratch_path(t.spark, "table")
    pairs = t.posts_raw.select("tid", "sender_uid", "hashtags")
    for half in (0, 1):
        part = pairs.where(F.col("tid") % 2 == half).drop("tid")
        sinks.write_delimited(part, f"{path}/half={half}", header=False)
        sinks.load_new_files(t.spark, f"{path}/*/*.csv", location, USER_TAGS)
    return sinks.load_new_files(t.spark, f"{path}/*/*.csv", location, USER_TAGS)


query("load_new_files", "SELECT sender_uid, hashtags FROM posts_raw")(_loaded_again)


def _saved(t):
    table = f"starling_{uuid.uuid4().hex}"
    location = scratch_path(t.spark, "table")
    sinks.save_table(interactions(t.posts_raw), table, location)
    sinks.save_table(interactions(t.posts), table, location)
    return t.spark.table(table)


query("save_result_table", "SELECT lo, hi, cnt FROM interaction")(_saved)


def _dumped(t):
    path = scratch_path(t.spark, "dump")
    tables = {"posts": t.posts_raw, "users": t.users, "profiles": t.user_mid}
    sinks.export_tables(tables, path)
    read = sinks.restore_tables(t.spark, tables, path)
    # Each restored row as one text, by the name of its table.
    rows = [read[name].select(F.lit(name).alias("name"), F.concat_ws("|", *tables[name].columns).alias("line")) for name in tables]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


query(
    "export_serving_tables",
    """SELECT 'posts' AS name, concat_ws('|', tid, timestamp, content, reply_to_uid, sender_uid, retweet_to_uid, hashtags, lang)
  AS line FROM posts_raw UNION ALL SELECT 'users', concat_ws('|', uid, screen_name, description) FROM users
  UNION ALL SELECT 'profiles', concat_ws('|', uid, screen_name, description, timestamp) FROM user_mid""",
)(_dumped)


def _written(t):
    path = scratch_path(t.spark, "written")
    tables = {"posts": t.posts_raw, "users": t.users, "profiles": t.user_mid}
    counts = [(name, sinks.counted(df, lambda df, name=name: df.write.parquet(f"{path}/{name}"))) for name, df in tables.items()]
    return small_table(t.spark, counts, name=pa.string(), rows=pa.int64())


query(
    "agg_written_rows",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS rows FROM {view}"
        for name, view in (("posts", "posts_raw"), ("users", "users"), ("profiles", "user_mid"))
    ),
)(_written)


def _served(t):
    path = scratch_path(t.spark, "serving")
    sinks.write_serving(interactions(t.posts), path, ["lo", "hi"])
    return t.spark.read.parquet(path)


query("serving_layout", "SELECT lo, hi, cnt FROM interaction")(_served)
