"""The same results as SQL for DuckDB, written without the engine's own steps."""

from __future__ import annotations

# Spark's default English stop words.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()

_STOP = ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS)

_MICROS = "'%Y-%m-%d %H:%M:%S.%f'"

# Common table expressions, joined by need.
_B = f"""
b AS (
  SELECT event_id, user_id::VARCHAR || '-' || strftime(ts, '%Y-%m-%d') AS user_session, user_id,
         TRY_CAST(props ->> '$.k' AS BIGINT) AS product_id, event_type, ts
  FROM events
)"""

_P = """
p AS (
  SELECT p_partkey AS product_id, p_name AS name, p_brand AS brand,
         concat_ws('.', p_type, p_size::VARCHAR) AS category_code, p_retailprice AS price
  FROM part
)"""

_N = "n AS (SELECT b.*, p.name FROM b JOIN p USING (product_id))"

_ENRICHED = f"""
enriched AS (
  SELECT b.user_id, b.product_id, b.event_type, strftime(b.ts, {_MICROS}) AS event_time, b.user_session,
         p.name, p.brand, p.category_code, p.price
  FROM b JOIN p USING (product_id)
)"""

_SPENT = """
spent AS (
  SELECT *, coalesce(floor(epoch(ts)) - floor(epoch(previous)), 0)::DOUBLE AS time_spent
  FROM (SELECT *, lag(ts) OVER (PARTITION BY user_session ORDER BY ts, event_id) AS previous FROM n)
)"""


def _counts(prefix: str) -> str:
    names = {"view": "views", "click": "carts", "purchase": "purchases"}
    return ", ".join(
        f"(count(*) FILTER (event_type = '{kind}'))::BIGINT AS {prefix}_{name}" for kind, name in names.items()
    )


_SHARES = f"""
counted AS (SELECT user_session, product_id, user_id, name, {_counts("product")} FROM n GROUP BY ALL),
totals AS (SELECT user_session, {_counts("total")} FROM n GROUP BY ALL),
product_times AS (
  SELECT user_session, product_id, user_id, sum(time_spent) AS product_time FROM spent GROUP BY ALL
),
session_times AS (SELECT user_session, sum(time_spent) AS total_time FROM spent GROUP BY ALL),
shares AS (
  SELECT user_session, product_id, user_id, name,
         CASE WHEN total_views > 0 THEN product_views / total_views ELSE 0 END::DOUBLE AS f1,
         CASE WHEN total_carts > 0 THEN product_carts / total_carts ELSE 0 END::DOUBLE AS f2,
         CASE WHEN total_purchases > 0 THEN product_purchases / total_purchases ELSE 0 END::DOUBLE AS f3,
         CASE WHEN total_time > 0 THEN product_time / total_time ELSE 0 END::DOUBLE AS f4
  FROM counted
  LEFT JOIN totals USING (user_session)
  LEFT JOIN product_times USING (user_session, product_id, user_id)
  LEFT JOIN session_times USING (user_session)
)"""

_MESSAGES = f"""
m AS (
  SELECT n.event_id, (event_id % 4)::INTEGER AS "partition", event_id // 4 AS "offset", user_session, user_id,
         product_id::VARCHAR AS product_id, name, event_type, ts,
         CASE WHEN event_id % 10 = 5 THEN 2 ELSE 1 END AS copies
  FROM n
),
good AS (SELECT * FROM m, range(copies) AS c(copy) WHERE event_id % 100 NOT IN (0, 1))"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _words(text: str) -> str:
    """The tokens of a text as a list."""
    return f"string_split_regex(regexp_replace(lower({text}), '\\s+$', ''), '\\s')"


def _kept(text: str) -> str:
    """The tokens of a text without stop words."""
    return f"list_filter({_words(text)}, lambda w: w NOT IN ({_STOP}))"


def _embedded(source: str, key: str, text: str, words: str) -> str:
    """Bucket weights of each ``key`` of ``source``, none for a text without tokens."""
    return f"""
hits AS (
  SELECT {key}, ('0x' || substr(md5(w), 1, 8))::BIGINT % 128 AS bucket, count(*) AS hits
  FROM (SELECT {key}, unnest({words}) AS w FROM (SELECT DISTINCT {key}, {text} FROM {source}))
  WHERE w <> '' GROUP BY ALL
),
lengths AS (SELECT {key}, sqrt(sum(hits * hits)) AS length FROM hits GROUP BY ALL),
cells AS (SELECT {key}, bucket, (hits / length)::FLOAT::DOUBLE AS weight FROM hits JOIN lengths USING ({key}))"""


_CELL = "coalesce(bucket, -1) AS bucket, coalesce(weight, 0) AS weight"

_NAME_CELLS = _embedded("p", "name", "name AS label", _kept("label"))

_PART = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"

_DESCRIPTION = """'A so-called "product", made for every home and every day: ' || p_name || ' ' || p_brand || ' ' || p_type"""


def _cells_of_list(table: str, keys: str, value: str) -> str:
    """The non-zero elements of a list column as rows."""
    return f"""SELECT {keys}, bucket, weight FROM (
  SELECT {keys}, unnest(range(len({value}))) AS bucket, unnest({value})::DOUBLE AS weight FROM {table}
) WHERE weight <> 0"""


def _point_id(time: str = f"strftime(ts, {_MICROS})") -> str:
    """The point id from the business key; no part of it is null in the test tables' keys but the product's."""
    product = "coalesce(product_id::VARCHAR, chr(0))"
    return f"sha256(concat_ws(chr(31), user_session, user_id::VARCHAR, {product}, event_type, {time}))"


def _known(source: str, text: str, min_count: int) -> str:
    """The distinct texts of ``source`` that hold a word of its vocabulary."""
    return f"""
words AS (SELECT {text} AS txt, unnest({_kept(text)}) AS word FROM {source}),
known AS (
  SELECT DISTINCT txt FROM words WHERE word IN (
    SELECT word FROM words WHERE word <> '' GROUP BY word HAVING count(*) >= {min_count}
  )
)"""


_COMBINED = """
combined AS (
  SELECT product_id::VARCHAR AS product_id, concat_ws(' ', user_id::VARCHAR, product_id::VARCHAR, name, brand,
         category_code, price::VARCHAR, event_type, event_time, user_session) AS label FROM enriched
)"""

_PROFILED = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, count(*) AS n_rows, count(*) - count({name}) AS n_nulls, "
    f"min({name})::VARCHAR AS min_value, max({name})::VARCHAR AS max_value FROM events"
    for name in ["event_id", "ts", "user_id", "event_type", "value", "props"]
)

ORACLE: dict[str, str] = {
    "interaction_scores": _with(_B, _P, _N, _SPENT, _SHARES)
    + "SELECT user_session, user_id, product_id, name, "
    "0.1::DOUBLE * f1 + 0.25::DOUBLE * f2 + 0.45::DOUBLE * f3 + 0.2::DOUBLE * f4 AS score FROM shares",
    "interaction_shares": _with(_B, _P, _N, _SPENT, _SHARES) + "SELECT * FROM shares",
    "event_indicators": "SELECT event_id, (event_type = 'view')::BIGINT AS views, "
    "(event_type = 'click')::BIGINT AS carts, (event_type = 'purchase')::BIGINT AS purchases FROM events",
    "session_totals": _with(_B) + f"SELECT user_session, {_counts('total')} FROM b GROUP BY ALL",
    "session_product_counts": _with(_B, _P, _N)
    + f"SELECT user_session, product_id, user_id, name, {_counts('product')} FROM n GROUP BY ALL",
    "time_spent": _with(_B, "n AS (SELECT * FROM b)", _SPENT)
    + f"SELECT event_id, strftime(previous, {_MICROS}) AS prev_event_time, time_spent FROM spent",
    "product_time": _with(_B, _P, _N, _SPENT)
    + "SELECT user_session, product_id, user_id, sum(time_spent) AS product_time_spent FROM spent GROUP BY ALL",
    "session_time": _with(_B, _P, _N, _SPENT)
    + "SELECT user_session, sum(time_spent) AS total_time_spent FROM spent GROUP BY ALL",
    "enriched_events": _with(_B, _P, _ENRICHED) + "SELECT * FROM enriched",
    "enriched_events_mixed_keys": _with(_B, _P, _ENRICHED.replace("JOIN p USING (product_id)", "JOIN p USING (product_id) WHERE event_id % 100 <> 0"))
    + "SELECT * REPLACE (product_id::VARCHAR AS product_id) FROM enriched",
    "enriched_events_broadcast": _with(_B, _P, _ENRICHED) + "SELECT * FROM enriched",
    "category_codes": _with(_P) + "SELECT product_id, category_code FROM p",
    "catalogue_merge": _with(_B, _P, _ENRICHED)
    + """SELECT event_time, event_type, product_id::VARCHAR AS product_id, category_code, brand, price,
       user_id::VARCHAR AS user_id, user_session, name FROM enriched
UNION ALL
SELECT strftime(l_shipdate, '%Y-%m-%d'), 'purchase', l_partkey::VARCHAR, NULL, l_returnflag, l_extendedprice,
       l_suppkey::VARCHAR, l_orderkey::VARCHAR, 'legacy' FROM lineitem""",
    "catalogue_clean": f"""SELECT p_partkey AS "productID", p_name AS name, p_size % 5 AS rating, p_type AS category,
       p_brand AS brand, p_type AS type, p_retailprice AS price, 'img/' || p_partkey AS "MainImage",
       base64(encode({_DESCRIPTION})) AS new_description FROM part""",
    "top_buyers": "SELECT user_id, count(*) AS purchase_count FROM events WHERE event_type = 'purchase' "
    "GROUP BY user_id ORDER BY purchase_count DESC, user_id LIMIT 3",
    "top_buyer_rows": _with(_B)
    + """SELECT event_id, user_id, product_id, event_type FROM b WHERE event_type = 'purchase' AND user_id IN (
  SELECT user_id FROM events WHERE event_type = 'purchase' GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 3)""",
    "purchases": "SELECT event_id, user_id FROM events WHERE event_type = 'purchase'",
    "events_per_user": "SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id",
    "distinct_counts": _with(_B)
    + """SELECT (SELECT count(*) FROM b) AS n_rows,
       (SELECT count(*) FROM (SELECT DISTINCT user_id FROM b)) AS distinct_user_id,
       (SELECT count(*) FROM (SELECT DISTINCT product_id FROM b)) AS distinct_product_id""",
    "profile_events": _PROFILED,
    "distinct_documents": "SELECT DISTINCT text, lang, source FROM documents",
    "except_rows": "SELECT l_partkey AS part, l_suppkey AS number FROM lineitem "
    "EXCEPT SELECT l_partkey, l_quantity::BIGINT FROM lineitem",
    "union_by_name": "SELECT c_name AS name, c_nationkey::BIGINT AS nation, c_acctbal AS balance, "
    "c_mktsegment AS segment FROM customer "
    "UNION ALL SELECT s_name, s_nationkey::BIGINT, s_acctbal, NULL FROM supplier",
    "ordered_limit": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderkey LIMIT 1000",
    "filled_measures": "SELECT c_custkey, c_mktsegment, "
    "(SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_orders FROM customer",
    "laid_out_by_user": "SELECT user_id, 1::BIGINT AS parts, count(*) AS n_events FROM events GROUP BY user_id",
    "laid_out_evenly": "SELECT 7::BIGINT AS parts, count(*) AS n_events, TRUE AS even FROM events",
    "combined_attributes": _with(_B, _P, _ENRICHED)
    + """SELECT user_session, event_time, concat_ws(' ', user_id::VARCHAR, product_id::VARCHAR, name, brand, category_code,
       price::VARCHAR, event_type, event_time, user_session) AS combined_attributes FROM enriched""",
    "event_time_utc_label": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' AS label FROM events",
    "parse_event_time": f"""SELECT event_id, strftime(t, {_MICROS}) AS parsed, coalesce(floor(epoch(t)), -1)::BIGINT AS seconds FROM (
  SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN date_trunc('milliseconds', ts) END AS t FROM events)""",
    "parse_events_json": _with(_B, _P, _N, _MESSAGES)
    + f"""SELECT "partition", "offset", user_session, user_id, product_id, name, event_type,
       strftime(ts, {_MICROS}) AS event_time FROM good""",
    "dead_letters": _with(_B, _P, _N, _MESSAGES)
    + """SELECT '{"user_session":"' || substr(user_session, 1, 3) AS value, "partition", "offset"
FROM m WHERE event_id % 100 = 1""",
    "encode_events_json": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS event_time, user_id, event_type, "
    "value AS amount, props FROM events",
    "point_ids": _with(_B) + f"SELECT event_id, {_point_id()} AS point_id FROM b",
    "embed_text": _with(_B, _P)
    + """SELECT event_id, coalesce(name, '') || ' ' || coalesce(event_type, '') AS embed_text
FROM b LEFT JOIN (
  SELECT p_partkey AS product_id, CASE WHEN p_type <> 'ECONOMY' THEN p_name END AS name FROM part
) USING (product_id)""",
    "topic_message_count": "SELECT sum(messages)::BIGINT AS messages FROM (SELECT max(event_id // 4) - min(event_id // 4) + 1 "
    "AS messages FROM events GROUP BY event_id % 4)",
    "topic_counts": """SELECT topic, sum(messages)::BIGINT AS messages FROM (
  SELECT topic, max(o) - min(o) + 1 AS messages FROM (
    SELECT event_id % 4 AS p, event_id // 4 AS o, CASE WHEN event_id // 4 % 3 = 0 THEN 'orders' ELSE 'events' END AS topic FROM events
  ) GROUP BY topic, p
) GROUP BY topic""",
    "topic_partition_counts": """SELECT event_id % 4 AS "partition", min(event_id // 4) AS earliest,
       max(event_id // 4) + 1 AS latest, max(event_id // 4) + 1 - min(event_id // 4) AS messages
FROM events GROUP BY event_id % 4""",
    "tokens": f"SELECT doc_id, array_to_string({_words('text')}, ' ') AS tokens FROM documents",
    "filtered_tokens": f"SELECT doc_id, array_to_string({_kept('text')}, ' ') AS tokens FROM documents",
    "hash_embedding": _with(_embedded("documents", "doc_id", "text", _kept("text")))
    + "SELECT doc_id, " + _CELL + " FROM documents LEFT JOIN cells USING (doc_id)",
    "model_embedding": f"""
WITH letters AS (
  SELECT p_partkey AS product_id, unnest(string_split(array_to_string({_kept('p_name')}, ' '), '')) AS letter FROM part
)
SELECT product_id, (unicode(letter) % 130)::BIGINT AS bucket, count(*)::DOUBLE AS weight FROM letters
WHERE unicode(letter) % 130 < 128 GROUP BY ALL""",
    "name_vectors": _with(_B, _P, _ENRICHED, _NAME_CELLS)
    + f"""SELECT user_session, event_time, event_type, product_id::VARCHAR AS product_id, category_code, brand,
       price::VARCHAR AS price, user_id::VARCHAR AS user_id, name, {_CELL}
FROM (SELECT DISTINCT * FROM enriched) LEFT JOIN cells USING (name)""",
    "retrain_vectors": _with(_B, _P, _ENRICHED, _NAME_CELLS)
    + f"""SELECT user_session, substr(event_time, 1, 19) || ' UTC' AS event_time, product_id::VARCHAR AS product_id,
       user_id::VARCHAR AS user_id, name, brand, category_code, price::VARCHAR AS price, event_type, {_CELL}
FROM enriched LEFT JOIN cells USING (name)""",
    "truncate_vectors": _cells_of_list("embeddings", "vec_id", "embedding[1:48]"),
    "vector_contract": "SELECT vec_id, CASE vec_id % 10 WHEN 1 THEN 'dimension' WHEN 2 THEN 'missing' "
    "WHEN 3 THEN 'element' ELSE 'good' END AS verdict FROM embeddings",
    "unit_vectors": "SELECT vec_id, len(embedding)::INTEGER AS dimension, 1.0::DOUBLE AS squared_length FROM embeddings",
    "vocabulary": _with(_B, _P, _N)
    + f"""SELECT word, count(*) AS n FROM (SELECT unnest({_kept('name')}) AS word FROM n)
WHERE word <> '' GROUP BY word HAVING count(*) >= 10""",
    "word2vec_training_shape": _with(_B, _P, _ENRICHED, _known("enriched", "name", 10))
    + """SELECT user_session, substr(event_time, 1, 19) || ' UTC' AS event_time, product_id, name, brand, category_code,
       price, event_type, 128 AS dimension, name IN (SELECT txt FROM known) AS has_words FROM enriched""",
    "word2vec_combined_shape": _with(_B, _P, _ENRICHED, _COMBINED, _known("combined", "label", 10))
    + "SELECT product_id, 128 AS dimension, label IN (SELECT txt FROM known) AS has_words FROM combined",
    "word2vec_behavior_shape": _with(_B, _P, _N, _known("n", "name", 0))
    + "SELECT user_id, product_id, name, 128 AS dimension, name IN (SELECT txt FROM known) AS has_words FROM n",
    "word2vec_means": _with(_B, _P, _N) + "SELECT DISTINCT name, 128::BIGINT AS dimension, TRUE AS is_mean FROM n",
    "behavior_vectors_hashed": _with(_B, _P, _N, _NAME_CELLS.replace("enriched", "n"))
    + f"SELECT user_id, product_id, name, {_CELL} FROM n LEFT JOIN cells USING (name)",
    "training_vectors_hashed": _with(_B, _P, _ENRICHED, _NAME_CELLS)
    + f"""SELECT user_id, product_id, name, brand, category_code, price::VARCHAR AS price, event_type,
       substr(event_time, 1, 19) || ' UTC' AS event_time, user_session, {_CELL}
FROM enriched LEFT JOIN cells USING (name)""",
    "combined_vectors_hashed": _with(
        _B,
        _P,
        _ENRICHED.replace("SELECT b.user_id", "SELECT DISTINCT b.user_id"),
        "combined AS (SELECT row_number() OVER () AS k, * FROM ("
        + _COMBINED.strip().removeprefix("combined AS (").removesuffix(")")
        + "))",
        _embedded("combined", "k", "label", _kept("label")),
    )
    + f"SELECT product_id, {_CELL} FROM combined LEFT JOIN cells USING (k)",
    "csv_times": _with(_B) + f"SELECT event_id, strftime(ts, {_MICROS}) AS event_time FROM b",
    "csv_reordered": """SELECT CASE WHEN p_partkey % 5 <> 0 THEN p_partkey END AS p_partkey,
       CASE WHEN p_partkey % 5 <> 0 THEN p_brand END AS p_brand, CASE WHEN p_partkey % 5 <> 0 THEN p_name END AS p_name,
       CASE WHEN p_partkey % 5 = 0 THEN p_name || ',' || p_brand END AS line FROM part""",
    "csv_single_file": "SELECT 1::BIGINT AS files, count(*) AS n_rows FROM orders",
    "topic_read": _with(_B, _P, _N, _MESSAGES)
    + """, texts AS (
  SELECT CASE WHEN event_id % 100 = 0 THEN NULL
              ELSE to_json({user_session: user_session, user_id: user_id, product_id: product_id, name: name,
                            event_type: event_type, event_time: strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')})::VARCHAR END AS json,
         event_id, "partition", "offset", copies FROM m
)
SELECT CASE WHEN event_id % 100 = 1 THEN substr(json, 1, 20) ELSE json END AS value, "partition", "offset"
FROM texts, range(copies)""",
    "topic_stream": _with(_B, _P, _N, _MESSAGES)
    + """, texts AS (
  SELECT to_json({user_session: user_session, user_id: user_id, product_id: product_id, name: name,
                  event_type: event_type, event_time: strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')})::VARCHAR AS json, user_session,
         event_id, copies FROM m WHERE event_id % 100 <> 0
)
SELECT CASE WHEN event_id % 100 <> 1 THEN user_session END AS user_session,
       CASE WHEN event_id % 100 = 1 THEN 20 ELSE length(json)::INTEGER END AS length FROM texts, range(copies)""",
    "retrain_message": "SELECT 'data_ready' AS event, count(*)::VARCHAR || ' points' AS message, TRUE AS has_timestamp FROM embeddings",
    "stream_restart": _with(_B, _P, _N, _MESSAGES) + "SELECT product_id, count(*) AS n FROM good GROUP BY product_id",
    "stream_bounded_batches": _with(_B, _P, _N, _MESSAGES)
    + """SELECT 3::BIGINT AS batches, (SELECT count(*) FROM good) AS good, count(*) AS dead FROM m, range(copies)
WHERE event_id % 100 = 1""",
    "csv_roundtrip": _PART,
    "csv_inferred": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice + 0.25::DOUBLE AS p_retailprice FROM part",
    "csv_quoted": f'SELECT p_partkey AS "productID", {_DESCRIPTION} AS new_description FROM part',
    "csv_quarantine": """SELECT p_partkey, p_name, CASE WHEN k > 0 THEN p_brand END AS p_brand,
       CASE k WHEN 0 THEN p_partkey || ',' || p_name
              WHEN 1 THEN p_partkey || ',' || p_name || ',' || p_brand || ',extra' END AS line
FROM (SELECT *, p_partkey % 5 AS k FROM part)""",
    "parquet_roundtrip": "SELECT p_partkey, p_name, p_retailprice FROM part",
    "table_append": """SELECT name, nation, 2 * count(*) AS n FROM (
  SELECT c_name AS name, c_nationkey::BIGINT AS nation FROM customer
  UNION ALL SELECT s_name, s_nationkey::BIGINT FROM supplier) GROUP BY ALL""",
    "vector_sink_points": _cells_of_list("embeddings", "vec_id, label", "embedding"),
    "retrain_event": "SELECT 'data_ready' AS event, 'New vectors are loaded. The model should be retrained.' AS message, "
    "count(*) AS n_points, TRUE AS has_timestamp FROM embeddings",
    "stream_ingest": _with(_B, _P, _N, _MESSAGES)
    + f"""SELECT user_id, product_id, event_type, strftime(ts, {_MICROS}) AS event_time, user_session, p.name, brand,
       category_code, price
FROM (SELECT * EXCLUDE (name) FROM good) g JOIN p ON p.product_id::VARCHAR = g.product_id""".replace(
        "SELECT user_id, product_id,", "SELECT user_id, g.product_id,"
    ),
    "stream_ingest_raw": _with(_B, _P, _N, _MESSAGES)
    + f"SELECT user_session, user_id, product_id, name, event_type, strftime(ts, {_MICROS}) AS event_time FROM good",
    "stream_vector_upsert": _with(
        _B,
        _P,
        _N,
        _MESSAGES,
        f"""
points AS (
  SELECT DISTINCT {_point_id("event_time")} AS point_id, user_id::VARCHAR AS user_id, name, event_time,
         user_session, product_id, event_type, name || ' ' || event_type AS label
  FROM (SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time FROM good)
)""",
        _embedded("points", "point_id", "label", _words("label")),
    )
    + f"""SELECT point_id, user_session, user_id, product_id, name, event_type, event_time, {_CELL}
FROM points LEFT JOIN cells USING (point_id)""",
}
ORACLE["hash_embedding_distinct"] = ORACLE["hash_embedding"]
ORACLE["stream_vector_upsert_compacted"] = ORACLE["stream_vector_upsert"]
ORACLE["load_names"] = ORACLE["name_vectors"]
ORACLE["load_retrain"] = ORACLE["retrain_vectors"]
ORACLE["interaction_scores_hot_sessions"] = ORACLE["interaction_scores"]
ORACLE["time_spent_hot_sessions"] = ORACLE["time_spent"]
ORACLE["enriched_events_hot_products"] = ORACLE["enriched_events"]
ORACLE["word2vec_blocked_means"] = ORACLE["word2vec_means"]
ORACLE["word2vec_blocked_training_shape"] = ORACLE["word2vec_training_shape"]
ORACLE["stream_point_table"] = ORACLE["stream_vector_upsert"]
ORACLE["stream_vector_upsert_once"] = _with(_B, _P, _N, _MESSAGES) + f"""SELECT product_id, count(*) AS written, count(*) AS points FROM (
  SELECT DISTINCT product_id, {_point_id("event_time")} AS point_id
  FROM (SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time FROM good)
) GROUP BY product_id"""
# A log keeps tombstones too, under offsets of their own.
ORACLE["log_read"] = _with(_B, _P, _N, _MESSAGES) + """SELECT "partition", sum((event_id % 100 <> 1)::INTEGER)::BIGINT AS good,
       count(*) AS records, count(*) AS offsets
FROM m, range(copies) WHERE event_id % 100 <> 0 GROUP BY ALL"""
ORACLE["log_stream"] = _with(_B, _P, _N, _MESSAGES) + "SELECT product_id, count(*) AS n, TRUE AS bounded FROM good GROUP BY product_id"
ORACLE["log_counts"] = _with(_B, _P, _N, _MESSAGES) + """SELECT 'behaviors' AS topic, sum(copies)::BIGINT AS messages FROM m
UNION ALL SELECT 'empty', 0 UNION ALL SELECT 'unknown', -1"""
ORACLE["resumable_distinct_load"] = ORACLE["distinct_documents"]
ORACLE["merged_profiles"] = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, count(*) AS n_rows, count(*) - count({name}) AS n_nulls, min({name})::DOUBLE AS low, "
    f"max({name})::DOUBLE AS high, {f'count(DISTINCT {name})' if whole else 'NULL::BIGINT'} AS n_distinct, TRUE AS half_is_half FROM lineitem"
    for name, whole in {"l_orderkey": True, "l_partkey": True, "l_quantity": False, "l_extendedprice": False}.items()
)
ORACLE["message_drift"] = _with(_B, _P, _N) + """SELECT * FROM (
  SELECT 'user_id' AS field, 'BIGINT' AS type, TRUE AS known, TRUE AS fits, (count(*) FILTER (event_id % 11 <> 0)) AS n FROM n
  UNION ALL SELECT 'user_id', 'STRING', TRUE, FALSE, count(*) FILTER (event_id % 11 = 0) FROM n
  UNION ALL SELECT 'name', 'STRING', TRUE, TRUE, count(*) FROM n
  UNION ALL SELECT 'device', 'OBJECT', FALSE, FALSE, count(*) FILTER (event_id % 7 = 0) FROM n
) WHERE n > 0"""
ORACLE["message_unknown_fields"] = _with(_B, _P, _N) + """SELECT user_id, count(*) AS n,
       count(*) FILTER (event_id % 7 = 0) AS with_unknown, 0::BIGINT AS with_misfits,
       min(CASE WHEN event_id % 7 = 0 THEN '{"device":{"kind":"phone","n":' || event_id || '}}' END) AS first_unknown
FROM n GROUP BY user_id"""
ORACLE["stored_layout_join"] = ORACLE["enriched_events"]
ORACLE["collection_scan"] = _with(_B) + """SELECT event_type, count(*) AS n, sum(key)::BIGINT AS total, 8::BIGINT AS splits, TRUE AS even
FROM (SELECT event_type, CASE WHEN event_id % 3 = 0 THEN 7 ELSE product_id * product_id END AS key FROM b) WHERE key >= 4 GROUP BY event_type"""
