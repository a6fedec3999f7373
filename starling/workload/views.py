"""The adapter views and shared intermediate results in SQL, written independently of the Spark plans."""

from __future__ import annotations

import re

from starling.operators.documents import PAGE_ROWS
from starling.workload import adapters as a


def _values(rows, columns: str) -> str:
    def lit(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS v({columns})"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


STOP, BANNED = _list(a.STOP), _list(a.BANNED)
URL = r"(https?|ftp)://[^\t\r\n /$.?#][^\t\r\n ]*"
TOKEN = "[a-zA-Z0-9''-]+"
POST_COLUMNS = "tid, timestamp, content, reply_to_uid, sender_uid, retweet_to_uid, hashtags, lang"


def epoch(x: str) -> str:
    return f"CAST(floor(epoch({x})) AS BIGINT)"


def short(x: str) -> str:
    return f"substr(sha256({x}), 1, 8)"


def text_of(*columns: str) -> str:
    return ", '|', ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)


def desc(*columns: str) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in columns)


def words(x: str) -> str:
    found = f"regexp_extract_all({x}, '{TOKEN}')"
    return f"list_transform(list_filter({found}, lambda t: regexp_matches(t, '[a-zA-Z]')), lambda t: lower(t))"


def no_urls(x: str) -> str:
    return f"regexp_replace({x}, '{URL}', ' ', 'g')"


def censored(x: str, mask_last: bool = False) -> str:
    runs = f"regexp_extract_all({x}, '[\\p{{L}}\\p{{Nd}}]+|[^\\p{{L}}\\p{{Nd}}]+')"
    mask = (
        f"CASE WHEN length(r) < 3 OR NOT list_contains({BANNED}, lower(r)) THEN r "
        "ELSE concat(r[1], repeat('*', length(r) - 2), r[-1]) END"
    )
    if mask_last:
        return f"array_to_string(list_transform({runs}, lambda r: {mask}), '')"
    body = f"array_to_string(list_transform(({runs})[1:-2], lambda r: {mask}), '')"
    return f"concat({body}, ({runs})[-1])"


def matches(x: str, p: str) -> str:
    return f"CASE WHEN length({p}) > 0 THEN (length({x}) - length(replace({x}, {p}, ''))) // length({p}) ELSE 0 END"


def paged(rows: str, keys: str, size: int = PAGE_ROWS, order: str = "timestamp, tid, content, hashtags") -> str:
    """Rows with their page among those of their keys."""
    return f"SELECT *, (row_number() OVER (PARTITION BY {keys} ORDER BY {order}) - 1) // {size} AS part FROM {rows} AS paged"


VIEWS = {
    "posts_raw": f"""SELECT l_orderkey * 10 + l_linenumber AS tid, {epoch('l_shipdate')} AS timestamp,
  concat(p_name, ' ', lower(p_type), ' ', o_orderpriority) AS content,
  CASE WHEN l_returnflag = 'A' THEN l_suppkey END AS reply_to_uid, o_custkey AS sender_uid,
  CASE WHEN l_returnflag = 'R' THEN l_suppkey END AS retweet_to_uid,
  concat(replace(p_brand, '#', ''), '_', CAST(p_size AS VARCHAR),
    CASE WHEN p_partkey % 5 = 0 THEN concat(',', p_type) ELSE '' END,
    CASE WHEN p_partkey % 7 = 0 THEN concat(',', replace(p_name, ' ', ',')) ELSE '' END) AS hashtags,
  CASE l_linestatus WHEN 'O' THEN 'en' ELSE 'fr' END AS lang
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "posts": f"""SELECT {POST_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY
  {desc('timestamp', 'content', 'reply_to_uid', 'sender_uid', 'retweet_to_uid', 'hashtags', 'lang')}) AS rn
  FROM posts_raw) AS t WHERE rn = 1""",
    "user_mid": f"""SELECT o_custkey AS uid, o_orderpriority AS screen_name, o_orderstatus AS description,
  {epoch('o_orderdate')} AS timestamp FROM orders""",
    "users": "SELECT c_custkey AS uid, c_name AS screen_name, c_mktsegment AS description FROM customer",
    "topic_posts": """SELECT d.doc_id AS tid, d.doc_id % 97 AS sender_uid, concat(d.text, ' ', coalesce(p.url, '')) AS content,
  d.n_chars + 1700000000 AS timestamp, d.n_chars % 1000 AS followers_count, l.quality AS favorite_count,
  l.toxic AS retweet_count, d.lang AS lang
  FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "popular": _values([(t,) for t in a.POPULAR], "term"),
    "contact_requests": _values(a.CONTACT_REQUESTS, "request_id, uid, type, phrase, hashtag"),
    "topic_requests": _values(a.TOPIC_REQUESTS, "request_id, uid_start, uid_end, time_start, time_end, n1, n2"),
    # The raw posts with their fields picked.
    "picked": """SELECT CASE WHEN tid % 7 <> 0 THEN tid END AS tid,
  CASE WHEN tid % 11 = 0 THEN NULL WHEN tid % 13 = 0 AND tid % 7 <> 0 THEN concat('x', tid) ELSE CAST(tid AS VARCHAR) END
    AS tid_str,
  CASE WHEN tid % 17 <> 0 THEN timestamp + tid % 86400 END AS timestamp,
  CASE WHEN tid % 19 = 0 THEN NULL WHEN tid % 23 = 0 THEN '' ELSE content END AS content,
  reply_to_uid, CAST(reply_to_uid AS VARCHAR) AS reply_to_uid_str,
  CASE WHEN tid % 31 <> 0 THEN sender_uid END AS sender_uid,
  CASE WHEN tid % 3 <> 0 THEN CAST(sender_uid AS VARCHAR) END AS sender_uid_str,
  concat('user', sender_uid) AS sender_screen_name,
  concat('writes ', lang, ' ', sender_uid % 7) AS sender_description,
  retweet_to_uid, CAST(retweet_to_uid AS VARCHAR) AS retweet_to_uid_str,
  CASE WHEN retweet_to_uid IS NOT NULL THEN concat('user', retweet_to_uid) END AS retweet_to_screen_name,
  CASE WHEN retweet_to_uid IS NOT NULL THEN concat('writes ', lang, ' ', retweet_to_uid % 7) END
    AS retweet_to_description,
  CASE WHEN tid % 37 <> 0 THEN hashtags ELSE '' END AS hashtags,
  CASE WHEN tid % 29 = 0 THEN 'de' ELSE lang END AS lang,
  tid % 1000 AS followers_count, tid % 50 AS favorite_count, CASE WHEN tid % 5 <> 0 THEN tid % 20 END AS retweet_count
  FROM posts_raw""",
    "valid_topic": """SELECT * FROM picked WHERE (tid IS NOT NULL OR tid_str IS NOT NULL)
  AND (sender_uid IS NOT NULL OR sender_uid_str IS NOT NULL) AND timestamp IS NOT NULL AND content IS NOT NULL""",
    "valid": """SELECT * EXCLUDE (followers_count, favorite_count, retweet_count) FROM valid_topic
  WHERE lang IN ('ar', 'en', 'fr', 'in', 'pt', 'es', 'tr', 'ja') AND hashtags <> ''""",
    "clean": """SELECT coalesce(TRY_CAST(tid_str AS BIGINT), tid) AS tid, timestamp, content, reply_to_uid,
  coalesce(TRY_CAST(sender_uid_str AS BIGINT), sender_uid) AS sender_uid, sender_screen_name, sender_description,
  retweet_to_uid, retweet_to_screen_name, retweet_to_description, hashtags, lang FROM valid""",
    "clean_users": """SELECT retweet_to_uid AS uid, retweet_to_screen_name AS screen_name,
  retweet_to_description AS description, timestamp FROM clean WHERE retweet_to_uid IS NOT NULL
  UNION ALL SELECT sender_uid, sender_screen_name, sender_description, timestamp FROM clean""",
    # The contact graph.
    "edges": """SELECT sender_uid AS a, reply_to_uid AS b, 0 AS type, 2 AS weight, tid, timestamp, content, hashtags
  FROM posts WHERE reply_to_uid IS NOT NULL
  UNION ALL SELECT sender_uid, retweet_to_uid, 1, 1, tid, timestamp, content, hashtags
  FROM posts WHERE retweet_to_uid IS NOT NULL""",
    "directed": """SELECT a AS uid, b AS contact_uid, type, tid, timestamp, content, hashtags FROM edges
  UNION ALL SELECT b, a, type, tid, timestamp, content, hashtags FROM edges""",
    "interaction": """SELECT least(a, b) AS lo, greatest(a, b) AS hi, CAST(sum(weight) AS BIGINT) AS cnt
  FROM edges GROUP BY 1, 2""",
    "latest": """SELECT tid, lo, hi, content, timestamp FROM (SELECT *, row_number() OVER (PARTITION BY lo, hi
  ORDER BY timestamp DESC, tid DESC) AS rn FROM (SELECT least(a, b) AS lo, greatest(a, b) AS hi, * FROM edges) AS e) AS t
  WHERE rn = 1""",
    "docs": f"""SELECT uid, contact_uid, type, part, string_agg(content, ',' ORDER BY timestamp, tid, content) AS content,
  string_agg(hashtags, ',' ORDER BY timestamp, tid, content, hashtags) AS hashtags
  FROM ({paged("directed", "uid, contact_uid, type")}) AS d GROUP BY 1, 2, 3, 4""",
    "tags": """SELECT sender_uid AS uid, lower(tag) AS tag, timestamp, tid, pos FROM (SELECT sender_uid, timestamp, tid,
  unnest(string_split(hashtags, ',')) AS tag, generate_subscripts(string_split(hashtags, ','), 1) AS pos FROM posts) AS t""",
    "kept_tags": "SELECT * FROM tags WHERE tag NOT IN (SELECT term FROM popular)",
    "tag_counts": "SELECT uid, tag, count(*) AS cnt FROM kept_tags GROUP BY 1, 2",
    "overlap": """SELECT i.lo, i.hi, CAST(coalesce(s.overlap, 0) AS BIGINT) AS overlap FROM interaction i LEFT JOIN
  (SELECT lo, hi, sum(x.cnt + y.cnt) AS overlap FROM interaction JOIN tag_counts x ON x.uid = lo
   JOIN tag_counts y ON y.uid = hi AND y.tag = x.tag GROUP BY 1, 2) AS s ON s.lo = i.lo AND s.hi = i.hi""",
    "combined": """SELECT d.uid, d.contact_uid, d.type, d.part, i.cnt AS interaction, l.content AS latest_post,
  o.overlap AS hashtag_cnt, d.hashtags, d.content, coalesce(u.screen_name, '') AS screen_name,
  coalesce(u.description, '') AS description FROM docs d
  JOIN interaction i ON i.lo = least(d.uid, d.contact_uid) AND i.hi = greatest(d.uid, d.contact_uid)
  JOIN latest l ON l.lo = i.lo AND l.hi = i.hi JOIN overlap o ON o.lo = i.lo AND o.hi = i.hi
  LEFT JOIN users u ON u.uid = d.contact_uid""",
    "contacts": f"""SELECT r.request_id, d.uid, d.contact_uid,
  sum({matches('d.content', 'r.phrase')}) AS phrase_matches,
  sum({matches('lower(d.hashtags)', 'lower(r.hashtag)')}) AS tag_matches
  FROM contact_requests r JOIN directed d ON d.uid = r.uid
  AND (r.type NOT IN ('reply', 'retweet') OR (r.type = 'reply') = (d.type = 0)) GROUP BY 1, 2, 3""",
    "scored": """SELECT c.*, i.cnt AS interaction, o.overlap, l.content AS latest_post,
  (1 + ln(c.phrase_matches + c.tag_matches + 1))
  * CASE WHEN o.overlap > 10 THEN 1 + ln(1 + o.overlap - 10) ELSE 1.0 END * (1 + ln(1 + i.cnt)) AS score
  FROM contacts c JOIN interaction i ON i.lo = least(c.uid, c.contact_uid) AND i.hi = greatest(c.uid, c.contact_uid)
  JOIN latest l ON l.lo = i.lo AND l.hi = i.hi JOIN overlap o ON o.lo = i.lo AND o.hi = i.hi""",
    # Topics.
    "word_lists": f"SELECT *, {words(no_urls('content'))} AS ws FROM topic_posts",
    "impacts": f"""SELECT *, len(list_filter(ws, lambda w: NOT list_contains({STOP}, w))) AS effective,
  len(list_filter(ws, lambda w: NOT list_contains({STOP}, w)))
  * (coalesce(favorite_count, 0) + coalesce(retweet_count, 0) + coalesce(followers_count, 0)) AS impact FROM word_lists""",
    "terms": """SELECT tid, word, count(*) AS cnt, any_value(n) AS doc_len
  FROM (SELECT tid, len(ws) AS n, unnest(ws) AS word FROM word_lists) AS t GROUP BY 1, 2""",
    "freqs": "SELECT word, count(*) AS df FROM terms GROUP BY 1",
    "found": """SELECT r.request_id, r.n1, r.n2, p.tid, p.impact, p.content FROM topic_requests r JOIN impacts p
  ON p.sender_uid BETWEEN r.uid_start AND r.uid_end AND p.timestamp BETWEEN r.time_start AND r.time_end""",
    "request_scores": f"""SELECT request_id, n1, word, sum(tf * ln(n / df) * ln(impact + 1)) AS score FROM (
  SELECT f.request_id, f.n1, t.word, f.impact, CAST(t.cnt AS DOUBLE) / t.doc_len AS tf,
    CAST(s.n AS DOUBLE) AS n, count(*) OVER (PARTITION BY f.request_id, t.word) AS df
  FROM found f JOIN terms t ON t.tid = f.tid
  JOIN (SELECT request_id, count(*) AS n FROM found GROUP BY 1) AS s ON s.request_id = f.request_id) AS x
  WHERE NOT list_contains({STOP}, word) GROUP BY 1, 2, 3""",
    "best_words": """SELECT request_id, rank, word, score FROM (SELECT *, row_number() OVER (PARTITION BY request_id
  ORDER BY round(score, 9) DESC, word) AS rank FROM request_scores) AS t WHERE rank <= n1""",
    "best_posts": f"""SELECT request_id, rank, tid, impact, content FROM (SELECT *, row_number() OVER (PARTITION BY request_id
  ORDER BY impact DESC, tid DESC) AS rank FROM found f WHERE EXISTS (SELECT 1 FROM best_words w
  WHERE w.request_id = f.request_id
  AND list_contains(list_transform(regexp_extract_all(f.content, '{TOKEN}'), lambda t: lower(t)), w.word))) AS t
  WHERE rank <= n2""",
    # Ledger.
    "numbered": """SELECT event_id, user_id, event_type, value, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
  AS rn FROM events""",
    "ledger_plain": f"""SELECT event_id, user_id AS chain_id, (rn - 1) // 5 AS pos, (rn - 1) % 5 AS idx,
  CAST({epoch('ts')} - CASE WHEN event_id % 97 = 0 THEN 1000000 ELSE 0 END AS VARCHAR) AS time,
  CASE WHEN event_type = 'purchase' THEN event_id % 3 END AS send, event_id % 4 AS recv,
  CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS amt,
  CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 11 - 1 AS VARCHAR) END AS fee FROM numbered
  UNION ALL SELECT event_id, 1000000 + user_id * 1000 + (rn - 1) // 5, 0, (rn - 1) % 5, CAST({epoch('ts')} AS VARCHAR),
  NULL, event_id % 4, CASE WHEN event_id % 41 = 0 THEN '1' ELSE '500000000' END, NULL FROM numbered
  WHERE user_id % 5 = 0""",
    "ledger_hashed": f"""SELECT *, CASE WHEN event_id % 50 = 0 THEN 'deadbeef' ELSE
  {short('concat(' + text_of('time', 'send', 'recv', 'amt', 'fee') + ')')} END AS hash FROM ledger_plain""",
    "ledger_txs": """SELECT chain_id, pos, idx, time, send, recv, amt, fee, hash,
  CASE WHEN event_id % 4 = 0 AND send IS NOT NULL THEN CAST(concat('0x', hash) AS BIGINT) END AS sig FROM ledger_hashed""",
    "ledger_parts": """SELECT chain_id, pos, CAST(CASE WHEN (chain_id + pos) % 23 = 0 THEN pos + 1 ELSE pos END AS INTEGER) AS id,
  CAST(pos AS VARCHAR) AS pow, CASE WHEN (chain_id + pos) % 4 = 0 THEN '80000000' ELSE 'ffffffff' END AS target,
  string_agg(hash, '|' ORDER BY idx) AS hashes, max_by(amt, idx) AS last_amt FROM ledger_txs GROUP BY 1, 2""",
    "ledger_blocks": f"""SELECT *, CASE WHEN pos % 2 = 1 THEN {short("concat(chain_id, '|', pos)")}
  WHEN chain_id % 9 = 0 THEN '00000001'
  ELSE {short('''concat(sha256(concat(id, '|', CASE WHEN pos = 0 THEN '00000000'
    ELSE ''' + short("concat(chain_id, '|', pos - 1)") + ''' END, '|', hashes)), pow)''')} END AS hash FROM ledger_parts""",
    "bad_ids": "SELECT chain_id, pos, id FROM ledger_blocks WHERE id <> pos",
    "bad_amounts": """SELECT chain_id, pos, idx, amt, fee FROM ledger_txs
  WHERE CAST(amt AS BIGINT) < 0 OR CAST(fee AS BIGINT) < 0""",
    "bad_times": """SELECT chain_id, pos, idx, time FROM (SELECT *, lag(CAST(time AS BIGINT), 1, 0) OVER (PARTITION BY chain_id
  ORDER BY pos, idx) AS prev FROM ledger_txs) AS t WHERE CAST(time AS BIGINT) < prev""",
    "entries": """SELECT chain_id, pos, idx, send AS account, 0 AS side, -CAST(amt AS BIGINT) AS delta FROM ledger_txs
  WHERE send IS NOT NULL
  UNION ALL SELECT chain_id, pos, idx, recv, 1, CAST(amt AS BIGINT) FROM ledger_txs""",
    "bad_balances": """SELECT chain_id, pos, idx, account AS send, CAST(-delta AS BIGINT) AS amt,
  CAST(coalesce(held, 0) AS BIGINT) AS balance, seen > 0 AS known FROM (SELECT *, sum(delta) OVER w AS held,
  count(*) OVER w AS seen FROM entries WINDOW w AS (PARTITION BY chain_id, account ORDER BY pos, idx, side
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS t
  WHERE side = 0 AND (seen = 0 OR held < -delta)""",
    "bad_rewards": """SELECT chain_id, pos, CAST(last_amt AS BIGINT) AS paid, CAST(500000000 // pow(2, pos // 2) AS BIGINT) AS due
  FROM ledger_blocks WHERE CAST(last_amt AS BIGINT) <> CAST(500000000 // pow(2, pos // 2) AS BIGINT)""",
    "bad_tx_hashes": f"""SELECT chain_id, pos, idx, hash FROM ledger_txs
  WHERE hash <> {short('concat(' + text_of('time', 'send', 'recv', 'amt', 'fee') + ')')}""",
    "bad_block_hashes": f"""SELECT chain_id, pos, hash FROM (SELECT *, lag(hash, 1, '') OVER (PARTITION BY chain_id ORDER BY pos) AS prev
  FROM ledger_blocks) AS t WHERE hash <> {short('''concat(sha256(concat(id, '|',
  CASE WHEN id = 0 THEN '00000000' ELSE prev END, '|', hashes)), pow)''')}""",
    "bad_targets": "SELECT chain_id, pos, hash, target FROM ledger_blocks WHERE hash > target",
    "bad_signatures": """SELECT chain_id, pos, idx, hash, sig FROM ledger_txs WHERE sig IS NOT NULL
  AND CASE send WHEN 0 THEN 1 WHEN 1 THEN sig % 1561906343821
    ELSE (CAST(sig AS HUGEINT) * sig) % 1561906343821 END <> CAST(concat('0x', hash) AS BIGINT)""",
    "invalid": " UNION ".join(
        f"SELECT chain_id FROM bad_{name}"
        for name in (
            "ids",
            "amounts",
            "times",
            "balances",
            "rewards",
            "tx_hashes",
            "block_hashes",
            "targets",
            "signatures",
        )
    ),
}


def with_views(sql: str) -> str:
    """Put the views a query names in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"(?:FROM|JOIN)\s+{name}\b", text):
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED (\n{VIEWS[name]})" for name in needed) + "\n" + sql
