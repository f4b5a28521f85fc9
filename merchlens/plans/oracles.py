"""The same results as DuckDB SQL over the driver's tables."""

RATINGS = """ratings AS (
  SELECT CAST(o_custkey AS INT) AS user_id, CAST(l_partkey AS INT) AS product_id,
         CAST(ceil(l_quantity / 10) AS DOUBLE) AS score, CAST(epoch(l_shipdate) AS BIGINT) AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

EVENTS = """ev AS (
  SELECT event_id, CAST(user_id AS INT) AS user_id,
         CAST(json_extract_string(props, '$.k') AS INT) AS product_id,
         CAST(1 + CAST(floor(value) AS BIGINT) % 5 AS DOUBLE) AS score,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts, event_type
  FROM events)"""

PRODUCTS = """products AS (
  SELECT CAST(p_partkey AS INT) AS product_id, p_name AS name, '' AS image_url,
         p_type AS categories, replace(p_name, ' ', '|') AS tags
  FROM part)"""

SERVED = """averages AS (SELECT product_id, avg(score) AS avg FROM ratings GROUP BY product_id),
served AS (
  SELECT p.product_id, name, image_url, categories, tags,
         round(coalesce(avg, 0.0), 6) AS avg_score
  FROM products p LEFT JOIN averages a ON p.product_id = a.product_id)"""

SIMS = """sims AS (
  SELECT CAST(a.vec_id AS INT) AS product_id, CAST(b.vec_id AS INT) AS sim_product_id,
         list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS sim
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
close AS (SELECT * FROM sims WHERE sim > 0.1)"""

FACTORS = """dots AS (
  SELECT CAST(a.vec_id AS INT) AS user_id, CAST(b.vec_id AS INT) AS product_id,
         list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS dot
  FROM embeddings a JOIN embeddings b ON a.vec_id % 2 = 0 AND b.vec_id % 2 = 1)"""

HASH = """
  CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INT)"""

USERS = f"""hashed AS (
  SELECT *, list_reduce(
           list_transform(string_split(c_name, ''), lambda x: CAST(ord(x) AS BIGINT)),
           lambda h, c: (h * 31 + c) & 4294967295) AS h
  FROM customer),
users AS (
  SELECT {HASH} AS user_id, c_name AS username, c_custkey, c_mktsegment FROM hashed)"""

NEWEST = "ORDER BY ts DESC, product_id DESC, score DESC"


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _month(column: str) -> str:
    return f"CAST(strftime({column}, '%Y%m') AS INT)"


def _recent(source: str, n: int) -> str:
    return f"""SELECT user_id, product_id, score, ts, position FROM (
      SELECT user_id, product_id, score, ts,
             CAST(row_number() OVER (PARTITION BY user_id {NEWEST}) AS INT) AS position
      FROM {source}) WHERE position <= {n}"""


def _latest(source: str) -> str:
    return f"""SELECT user_id, product_id, score, ts FROM (
      SELECT *, row_number() OVER (
        PARTITION BY user_id, product_id ORDER BY ts DESC, score DESC) AS rn
      FROM {source}) WHERE rn = 1"""


def _upsert(base: str, updates: str, keep_ts: bool = False) -> str:
    ts = "min(ts) OVER (PARTITION BY user_id, product_id)" if keep_ts else "ts"
    return f"""SELECT user_id, product_id, score, ts_out AS ts FROM (
      SELECT user_id, product_id, score, {ts} AS ts_out, row_number() OVER (
        PARTITION BY user_id, product_id ORDER BY ts DESC, upd DESC, score DESC) AS rn
      FROM (SELECT user_id, product_id, score, ts, 0 AS upd FROM {base}
            UNION ALL SELECT user_id, product_id, score, ts, 1 FROM {updates}))
      WHERE rn = 1"""


def _log(column: str = "event_type") -> str:
    return f"""lines AS (
  SELECT CASE WHEN {column} = 'error' THEN NULL
              WHEN {column} = 'signup'
                THEN concat_ws('|', user_id, product_id, event_type, ts)
              ELSE concat_ws('|', user_id, product_id, score, ts) END AS value,
         {column} AS kind, user_id, product_id, score, ts
  FROM ev)"""


def _rerank(source: str) -> tuple[str, ...]:
    """Latest trigger and newest 20 ratings per user, candidates and scores."""
    return (
        f"""newest AS (
  SELECT user_id, product_id, score,
         row_number() OVER (PARTITION BY user_id {NEWEST}) AS position
  FROM {source})""",
        f"""candidates AS (
  SELECT user_id, candidate, sim FROM (
    SELECT t.user_id, s.sim_product_id AS candidate, s.sim, row_number() OVER (
             PARTITION BY t.user_id ORDER BY s.sim DESC, s.sim_product_id) AS rn
    FROM newest t JOIN close s ON t.product_id = s.product_id
    WHERE t.position = 1 AND NOT EXISTS (
      SELECT 1 FROM {source} r
      WHERE r.user_id = t.user_id AND r.product_id = s.sim_product_id))
  WHERE rn <= 20)""",
        """scored AS (
  SELECT c.user_id, c.candidate AS product_id,
         avg(s.sim * r.score)
         + log10(greatest(count(*) FILTER (WHERE r.score > 3), 1))
         - log10(greatest(count(*) FILTER (WHERE r.score <= 3), 1)) AS score
  FROM candidates c
  JOIN newest r ON r.user_id = c.user_id AND r.position <= 20
  JOIN close s ON s.product_id = c.candidate AND s.sim_product_id = r.product_id
  WHERE s.sim > 0.2
  GROUP BY c.user_id, c.candidate)""",
        """ranked AS (
  SELECT user_id, product_id, score,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS INT) AS rank
  FROM scored)""",
        "rated_users AS (SELECT user_id FROM newest WHERE position = 1)",
    )


def _scored_batch(n: int, triggers: str, recents: str, rated: str) -> tuple[str, ...]:
    """Scored candidates of one batch: its newest ratings, the lists by then, all rated by then."""
    return (
        f"""newest{n} AS (
  SELECT user_id, product_id, row_number() OVER (PARTITION BY user_id {NEWEST}) AS position FROM {triggers})""",
        f"""recent{n} AS (
  SELECT user_id, product_id, score, row_number() OVER (PARTITION BY user_id {NEWEST}) AS position
  FROM {recents})""",
        f"""candidates{n} AS (
  SELECT user_id, candidate FROM (
    SELECT t.user_id, s.sim_product_id AS candidate, row_number() OVER (
             PARTITION BY t.user_id ORDER BY s.sim DESC, s.sim_product_id) AS rn
    FROM newest{n} t JOIN close s ON t.product_id = s.product_id
    WHERE t.position = 1 AND NOT EXISTS (
      SELECT 1 FROM {rated} r WHERE r.user_id = t.user_id AND r.product_id = s.sim_product_id))
  WHERE rn <= 20)""",
        f"""scored{n} AS (
  SELECT c.user_id, c.candidate AS product_id,
         avg(s.sim * r.score)
         + log10(greatest(count(*) FILTER (WHERE r.score > 3), 1))
         - log10(greatest(count(*) FILTER (WHERE r.score <= 3), 1)) AS score
  FROM candidates{n} c
  JOIN recent{n} r ON r.user_id = c.user_id AND r.position <= 20
  JOIN close s ON s.product_id = c.candidate AND s.sim_product_id = r.product_id
  WHERE s.sim > 0.2
  GROUP BY c.user_id, c.candidate)""",
    )


_LISTS = """SELECT u.user_id, rank, product_id, round(score, 6) AS score
FROM rated_users u LEFT JOIN ranked k ON u.user_id = k.user_id"""

_SERVE_USERS = """requests AS (
  SELECT c_name AS username, CAST(c_custkey AS INT) AS user_id FROM customer
  UNION ALL
  SELECT 'Supplier#' || CAST(s_suppkey AS VARCHAR), NULL FROM supplier),
answered AS (
  SELECT r.username, k.rank, k.product_id, round(k.score, 6) AS score
  FROM requests r LEFT JOIN ranked k ON r.user_id = k.user_id AND k.rank <= 5)"""

_SERVE_USERS_SELECT = """SELECT username, rank, a.product_id, score, name, avg_score
FROM answered a LEFT JOIN served s ON a.product_id = s.product_id
WHERE a.product_id IS NULL OR s.product_id IS NOT NULL"""

_USER_LISTS = f"""latest AS ({_latest("ratings")}),
ranked AS (
  SELECT user_id, product_id, score, rank FROM (
    SELECT user_id, product_id, score, CAST(row_number() OVER (
             PARTITION BY user_id ORDER BY score DESC, product_id) AS INT) AS rank
    FROM latest WHERE score > 0) WHERE rank <= 20)"""

_RATING_REQUESTS = """requests AS (
  SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'nobody' ELSE c_name END AS username,
         CAST(l_partkey AS INT) AS product_id,
         CAST(CAST(floor(l_quantity) AS BIGINT) % 11 AS DOUBLE) AS score,
         CAST(epoch(l_shipdate) AS BIGINT) AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
accepted AS (
  SELECT u.user_id, product_id, score / 2 AS score, ts
  FROM requests r JOIN users u ON r.username = u.username)"""

# Arithmetic of the split, as the engine's hash of a rating states it.
_BUCKET = (
    "((((CAST(user_id AS BIGINT) * 1000003 + product_id) % 2147483647) * 48271"
    " + ts % 2147483647) % 2147483647 * 69621) % 2147483647 % 10000"
)

_MONTHS = f"""SELECT CAST(l_partkey AS INT) AS product_id, count(*) AS count,
  {_month("l_shipdate")} AS yearmonth
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL"""


ORACLES = {
    "product_file_scan": with_(
        PRODUCTS,
        select="""SELECT product_id, name, image_url, categories, tags,
          CAST(len(string_split(tags, '|')) AS INT) AS n_tags FROM products""",
    ),
    "rating_file_scan": with_(RATINGS, select="SELECT * FROM ratings"),
    "rating_file_quarantine": with_(
        EVENTS,
        select="""SELECT CAST(user_id AS VARCHAR) AS user_id,
          CAST(product_id AS VARCHAR) AS product_id, 'n/a' AS score,
          CAST(ts AS VARCHAR) AS ts FROM ev WHERE event_type = 'error'""",
    ),
    "ratings_table": with_(RATINGS, select="SELECT * FROM ratings"),
    "ratings_table_merge": with_(RATINGS, EVENTS, select=_upsert("ratings", "ev")),
    "rate_more": with_(
        RATINGS, select="SELECT product_id, count(product_id) AS count FROM ratings GROUP BY ALL"
    ),
    "ratings_log_merge": with_(RATINGS, EVENTS, select=_upsert("ratings", "ev")),
    "statistics_after_merges": with_(
        RATINGS,
        EVENTS,
        f"latest AS ({_latest('ratings')})",
        f"merged AS ({_upsert('latest', 'ev')})",
        select="""SELECT product_id, CAST(strftime(make_timestamp(ts * 1000000), '%Y%m') AS INT) AS yearmonth,
          count(*) AS count, round(avg(score), 6) AS avg FROM merged GROUP BY ALL""",
    ),
    "rate_more_recently": _MONTHS,
    "rate_more_recently_scale100": with_(
        RATINGS,
        select=f"""SELECT product_id, count(*) AS count,
          {_month("make_timestamp(ts * 100000)")} AS yearmonth FROM ratings GROUP BY ALL""",
    ),
    "rate_more_recently_sql": _MONTHS,
    "average_products": with_(
        RATINGS,
        select="SELECT product_id, round(avg(score), 6) AS avg FROM ratings GROUP BY ALL",
    ),
    "product_totals": with_(
        RATINGS,
        select="""SELECT product_id, count(*) AS count, round(avg(score), 6) AS avg
          FROM ratings GROUP BY ALL""",
    ),
    "distinct_users": with_(RATINGS, select="SELECT DISTINCT user_id FROM ratings"),
    "distinct_products": with_(RATINGS, select="SELECT DISTINCT product_id FROM ratings"),
    "hot_products": with_(
        RATINGS,
        PRODUCTS,
        SERVED,
        f"""monthly AS (SELECT product_id, count(*) AS count,
              {_month("make_timestamp(ts * 1000000)")} AS yearmonth FROM ratings GROUP BY ALL)""",
        """top AS (SELECT product_id, CAST(row_number() OVER (
              ORDER BY yearmonth DESC, count DESC, product_id) AS INT) AS rank
              FROM monthly QUALIFY rank <= 50)""",
        select="""SELECT s.*, r.rank FROM
          (SELECT product_id, min(rank) AS rank FROM top GROUP BY product_id) r
          JOIN served s ON r.product_id = s.product_id""",
    ),
    "most_rated_products": with_(
        RATINGS,
        PRODUCTS,
        SERVED,
        "counts AS (SELECT product_id, count(*) AS count FROM ratings GROUP BY product_id)",
        """top AS (SELECT product_id, count, CAST(row_number() OVER (
              ORDER BY count DESC, product_id) AS INT) AS rank FROM counts QUALIFY rank <= 50)""",
        select="SELECT s.*, rank, count FROM top t JOIN served s ON t.product_id = s.product_id",
    ),
    "rating_upsert": with_(RATINGS, EVENTS, select=_upsert("ratings", "ev")),
    "rating_upsert_keep_ts": with_(RATINGS, EVENTS, select=_upsert("ratings", "ev", True)),
    "latest_ratings": with_(RATINGS, select=_latest("ratings")),
    "recent_ratings": with_(RATINGS, select=_recent("ratings", 20)),
    "recent_ratings_inclusive": with_(EVENTS, select=_recent("ev", 21)),
    "recent_ratings_distinct": with_(
        EVENTS, f"latest AS ({_latest('ev')})", select=_recent("latest", 20)
    ),
    "capped_recent_lists": with_(
        EVENTS,
        f"recent AS ({_recent('ev', 40)})",
        select="SELECT user_id, position AS rank, product_id, score FROM recent",
    ),
    "score_scaling": """SELECT c_custkey,
      (CASE WHEN c >= 0 THEN (c + 1) // 2 ELSE -((-c + 1) // 2) END) / 100.0 AS half
      FROM (SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS c FROM customer)""",
    "query_recoding": "SELECT doc_id, text FROM documents",
    "query_recoding_mixed": "SELECT doc_id, text FROM documents",
    "load_statistics": with_(
        RATINGS,
        select="""SELECT product_id, count(*) AS count, round(avg(score), 6) AS avg
          FROM ratings GROUP BY product_id""",
    ),
    "rating_extremes": with_(
        EVENTS,
        """raw AS (SELECT user_id, product_id, event_id % 10 AS k,
          CASE event_id % 10 WHEN 0 THEN '1e100' WHEN 1 THEN '1e999' WHEN 2 THEN '' WHEN 3 THEN '-.5e1'
            WHEN 4 THEN 'NaN' ELSE CAST(score AS VARCHAR) END AS s,
          CASE event_id % 10 WHEN 5 THEN '-9223372036854775808' WHEN 6 THEN '9000000000000000'
            WHEN 7 THEN '253402300799' WHEN 8 THEN '99999999999999999999'
            ELSE CAST(ts AS VARCHAR) END AS t FROM ev)""",
        select="""SELECT user_id, product_id, CAST(s AS DOUBLE) AS score, CAST(t AS BIGINT) AS ts,
            CASE WHEN k = 7 THEN 999912
              ELSE CAST(strftime(make_timestamp(CAST(t AS BIGINT) * 1000000), '%Y%m') AS INT) END AS month,
            '' AS value FROM raw WHERE k IN (0, 3, 7, 9)
          UNION ALL SELECT NULL, NULL, NULL, NULL, NULL,
            concat_ws('|', user_id, product_id, s, t) FROM raw WHERE k NOT IN (0, 3, 7, 9)""",
    ),
    "als_prediction_facts": with_(
        RATINGS,
        f"parted AS (SELECT *, {_BUCKET} AS bucket FROM ratings)",
        select="""SELECT user_id, product_id, score, ts, true AS is_number FROM parted
          WHERE bucket >= 8000 AND user_id IN (SELECT user_id FROM parted WHERE bucket < 8000)
            AND product_id IN (SELECT product_id FROM parted WHERE bucket < 8000)""",
    ),
    "als_grid_facts": """SELECT CAST(r AS INT) AS rank, g AS reg_param, true AS better
      FROM (VALUES (4), (8)) a(r), (VALUES (0.1::DOUBLE), (1.0::DOUBLE)) b(g)""",
    "als_list_facts": with_(
        RATINGS,
        select="""SELECT DISTINCT user_id, true AS in_order, true AS positive,
          true AS dot_products, true AS gapless FROM ratings""",
    ),
    "factor_user_recs": with_(
        FACTORS,
        select="""SELECT user_id, CAST(row_number() OVER w AS INT) AS rank, product_id, round(dot, 6) AS score
          FROM dots WHERE dot > 0 WINDOW w AS (PARTITION BY user_id ORDER BY dot DESC, product_id)
          QUALIFY row_number() OVER w <= 20""",
    ),
    "factor_user_recs_pruned": with_(
        FACTORS,
        select="""SELECT user_id, CAST(row_number() OVER w AS INT) AS rank, product_id, round(dot, 6) AS score
          FROM dots WHERE dot > 0 WINDOW w AS (PARTITION BY user_id ORDER BY dot DESC, product_id)
          QUALIFY row_number() OVER w <= 20""",
    ),
    "summed_equations": with_(
        RATINGS, select="SELECT DISTINCT product_id, true AS solved FROM ratings"
    ),
    "factor_unrated_user_recs": with_(
        EVENTS,
        FACTORS,
        select="""SELECT user_id, CAST(row_number() OVER w AS INT) AS rank, product_id, round(dot, 6) AS score
          FROM dots WHERE dot > 0 AND (user_id, product_id) NOT IN (
            SELECT (user_id * 2, product_id * 2 + 1) FROM ev)
          WINDOW w AS (PARTITION BY user_id ORDER BY dot DESC, product_id)
          QUALIFY row_number() OVER w <= 20""",
    ),
    "factor_predictions": with_(
        EVENTS,
        FACTORS,
        """rated AS (SELECT DISTINCT user_id * 2 AS user_id, product_id * 2 + 1 AS product_id FROM ev)""",
        select="""SELECT user_id, product_id, round(dot, 6) AS prediction
          FROM rated JOIN dots USING (user_id, product_id)""",
    ),
    "user_id_hash": with_(USERS, select="SELECT username, user_id FROM users"),
    "user_dim_load": with_(
        USERS,
        select="""SELECT user_id, username, true AS first,
          CAST(epoch(min(o_orderdate)) AS BIGINT) AS created_at
          FROM orders JOIN users ON o_custkey = c_custkey
          WHERE c_mktsegment <> 'HOUSEHOLD' GROUP BY ALL""",
    ),
    "user_names_taken": "SELECT c_name AS username FROM customer WHERE c_mktsegment = 'HOUSEHOLD'",
    "user_id_collisions": """SELECT DISTINCT user_id, username FROM (
      SELECT CAST(round(c_acctbal * 100) AS BIGINT) AS user_id, c_name AS username,
             min(c_name) OVER (PARTITION BY round(c_acctbal * 100)) AS low,
             max(c_name) OVER (PARTITION BY round(c_acctbal * 100)) AS high
      FROM customer) WHERE low <> high""",
    "user_dim_update": with_(
        USERS,
        """newest AS (
          SELECT o_custkey, o_orderstatus, o_orderpriority, row_number() OVER (
            PARTITION BY o_custkey
            ORDER BY o_orderdate DESC, o_orderstatus = 'O' DESC, o_orderpriority DESC,
                     o_orderstatus DESC) AS rn
          FROM orders)""",
        select="""SELECT user_id, username, coalesce(o_orderstatus = 'O', true) AS first,
          coalesce(o_orderpriority || '|' || o_orderstatus, c_mktsegment) AS pref_genres
          FROM users LEFT JOIN newest ON o_custkey = c_custkey AND rn = 1""",
    ),
    "log_filter_parse": with_(
        EVENTS,
        select="""SELECT user_id, product_id, score, ts FROM ev
          WHERE event_type NOT IN ('error', 'signup')""",
    ),
    "log_quarantine": with_(
        EVENTS, _log(), select="SELECT value FROM lines WHERE kind = 'signup'"
    ),
    "event_lines": with_(
        EVENTS,
        select="""SELECT event_id,
          'PRODUCT_RATING_PREFIX:' || concat_ws('|', user_id, product_id, score, ts) AS value
          FROM ev""",
    ),
    "topic_messages": with_(
        EVENTS,
        _log(),
        select="""SELECT value, CAST(length(value) AS INT) AS n FROM lines
          WHERE value IS NOT NULL""",
    ),
    "item_cosine": with_(
        SIMS, select="SELECT product_id, sim_product_id, round(sim, 6) AS sim FROM close"
    ),
    "item_sims_sorted": with_(
        SIMS, select="SELECT product_id, sim_product_id, round(sim, 6) AS sim FROM close"
    ),
    "item_sim_lists_pruned": with_(
        SIMS,
        select="""SELECT product_id AS item, rank, sim_product_id AS product_id,
          round(sim, 6) AS sim FROM (
            SELECT *, CAST(row_number() OVER (
              PARTITION BY product_id ORDER BY sim DESC, sim_product_id) AS INT) AS rank
            FROM close) WHERE rank <= 20""",
    ),
    "vector_extremes": with_(
        SIMS,
        """left_over AS (SELECT * FROM close
          WHERE product_id % 7 NOT IN (3, 4) AND sim_product_id % 7 NOT IN (3, 4))""",
        select="""SELECT product_id AS item, rank, sim_product_id AS product_id,
          round(sim, 6) AS sim FROM (
            SELECT *, CAST(row_number() OVER (
              PARTITION BY product_id ORDER BY sim DESC, sim_product_id) AS INT) AS rank
            FROM left_over) WHERE rank <= 5""",
    ),
    "item_sim_lists": with_(
        SIMS,
        select="""SELECT product_id AS item, rank, sim_product_id AS product_id,
          round(sim, 6) AS sim FROM (
            SELECT *, CAST(row_number() OVER (
              PARTITION BY product_id ORDER BY sim DESC, sim_product_id) AS INT) AS rank
            FROM close) WHERE rank <= 20""",
    ),
    "pair_cosine": with_(
        EVENTS,
        SIMS.split(",\nclose AS")[0].replace("JOIN embeddings b ON a.vec_id <> b.vec_id",
                                             "CROSS JOIN embeddings b"),
        """steps AS (
          SELECT product_id, lag(product_id) OVER (
            PARTITION BY user_id ORDER BY ts, event_id) AS sim_product_id FROM ev)""",
        select="""SELECT DISTINCT p.product_id, p.sim_product_id, round(sim, 6) AS sim
          FROM steps p JOIN sims s
          ON p.product_id = s.product_id AND p.sim_product_id = s.sim_product_id""",
    ),
    "unrated_similars": with_(
        EVENTS,
        SIMS,
        *_rerank("ev"),
        select="SELECT user_id, candidate, round(sim, 6) AS sim FROM candidates",
    ),
    "rerank_scores": with_(
        EVENTS,
        SIMS,
        *_rerank("ev"),
        select="SELECT user_id, product_id, round(score, 6) AS score FROM scored",
    ),
    "rerank_lists": with_(EVENTS, SIMS, *_rerank("ev"), select=_LISTS),
    "product_search": with_(
        RATINGS,
        PRODUCTS,
        SERVED,
        """patterns AS (SELECT * FROM (VALUES
          ('rings', 'ring$'), ('red', '^red'), ('wid?et', 'wid.et')) v(query, pattern))""",
        select="""SELECT query, product_id, name, image_url, categories, tags, avg_score AS score
          FROM patterns JOIN served ON regexp_matches(name, pattern)""",
    ),
    "product_search_table": with_(
        PRODUCTS,
        """words AS (SELECT DISTINCT word FROM (
          SELECT unnest(string_split(name, ' ')) AS word FROM products) WHERE word <> '')""",
        """patterns AS (SELECT 'begins-' || word AS query, '^' || word AS pattern FROM words
          UNION ALL SELECT 'ends-' || word, word || '.?$' FROM words
          UNION ALL SELECT * FROM (VALUES ('any-o', 'o.o'), ('either', 'red|blue'), ('none', 'q{3}zz')) v(q, p))""",
        """hits AS (SELECT DISTINCT query, product_id FROM patterns JOIN products
          ON regexp_matches(name, pattern))""",
        select="""SELECT query, count(*) AS n, CAST(sum(product_id) AS BIGINT) AS ids
          FROM hits GROUP BY query""",
    ),
    "product_lookup": with_(
        PRODUCTS,
        EVENTS,
        select="""SELECT product_id, name, image_url, categories, tags, 'few' AS n_asked FROM products
          WHERE product_id % 7 = 0 AND product_id IN (SELECT product_id FROM ev)
          UNION ALL SELECT product_id, name, image_url, categories, tags, 'many' FROM products
          WHERE product_id IN (SELECT product_id FROM ev)""",
    ),
    "product_info": with_(
        RATINGS,
        PRODUCTS,
        SERVED,
        select="""SELECT CAST(vec_id * 7 AS INT) AS product_id, name, image_url, categories, tags,
          avg_score FROM embeddings LEFT JOIN served ON vec_id * 7 = product_id""",
    ),
    "products_in_lists": with_(
        RATINGS,
        PRODUCTS,
        SERVED,
        EVENTS,
        select="""SELECT product_id, name, image_url, categories, tags, avg_score AS score
          FROM served WHERE product_id IN (SELECT product_id FROM ev)""",
    ),
    "serve_similars": with_(
        RATINGS,
        PRODUCTS,
        SERVED,
        SIMS,
        """ranked AS (SELECT product_id AS item, sim_product_id AS product_id, sim AS score,
          CAST(row_number() OVER (
            PARTITION BY product_id ORDER BY sim DESC, sim_product_id) AS INT) AS rank
          FROM close QUALIFY rank <= 10)""",
        """answered AS (SELECT p.product_id AS item, rank, r.product_id, r.score
          FROM products p LEFT JOIN ranked r ON p.product_id = r.item)""",
        select="""SELECT item, rank, a.product_id, round(score, 6) AS score, name, avg_score
          FROM answered a LEFT JOIN served s ON a.product_id = s.product_id
          WHERE a.product_id IS NULL OR s.product_id IS NOT NULL""",
    ),
    "serve_content_similars": with_(
        RATINGS,
        PRODUCTS,
        SERVED,
        """best AS (SELECT p_type, p_brand, CAST(p_partkey AS INT) AS product_id,
          p_retailprice AS score FROM part QUALIFY row_number() OVER (
            PARTITION BY p_type, p_brand ORDER BY p_retailprice DESC, p_partkey) <= 5)""",
        """ranked AS (SELECT CAST(p.p_partkey AS INT) AS item, b.product_id, b.score,
          CAST(row_number() OVER (
            PARTITION BY p.p_partkey ORDER BY b.score DESC, b.product_id) AS INT) AS rank
          FROM part p JOIN best b ON p.p_type = b.p_type AND p.p_brand = b.p_brand
          WHERE p.p_partkey <> b.product_id QUALIFY rank <= 3)""",
        select="""SELECT CAST(p.p_partkey AS INT) AS item, rank, r.product_id, score, name,
          avg_score FROM part p LEFT JOIN ranked r ON p.p_partkey = r.item
          LEFT JOIN served s ON r.product_id = s.product_id""",
    ),
    "user_top_products": with_(
        RATINGS, _USER_LISTS, select="SELECT user_id, rank, product_id, score FROM ranked"
    ),
    "serve_user_recs": with_(
        RATINGS, PRODUCTS, SERVED, _USER_LISTS, _SERVE_USERS, select=_SERVE_USERS_SELECT
    ),
    "serve_stream_recs": with_(
        RATINGS, PRODUCTS, SERVED, EVENTS, SIMS, *_rerank("ev"), _SERVE_USERS,
        select=_SERVE_USERS_SELECT,
    ),
    "record_ratings": with_(
        EVENTS, USERS, _RATING_REQUESTS, select=_upsert("ev", "accepted")
    ),
    "record_rating_lines": with_(
        USERS,
        _RATING_REQUESTS,
        select="""SELECT 'PRODUCT_RATING_PREFIX:' || concat_ws('|', user_id, product_id, score, ts)
          AS value, count(*) AS n FROM accepted GROUP BY ALL""",
    ),
    "record_rating_unknown": with_(
        USERS,
        _RATING_REQUESTS,
        select="SELECT * FROM requests WHERE username NOT IN (SELECT username FROM users)",
    ),
    "holdout_split": with_(
        RATINGS,
        select=f"""SELECT *, CASE WHEN {_BUCKET} < 8000 THEN 'train' ELSE 'test' END AS part
          FROM ratings""",
    ),
    "rmse_item_mean": with_(
        RATINGS,
        f"parted AS (SELECT *, {_BUCKET} AS bucket FROM ratings)",
        """means AS (SELECT product_id, avg(score) AS mean FROM parted WHERE bucket < 8000
          GROUP BY product_id)""",
        select="""SELECT round(sqrt(avg((score - mean) * (score - mean))), 6) AS rmse
          FROM parted p JOIN means m ON p.product_id = m.product_id WHERE bucket >= 8000""",
    ),
    "stream_recs": with_(
        EVENTS,
        "heard AS (SELECT * FROM ev WHERE event_type NOT IN ('error', 'signup'))",
        SIMS,
        *_rerank("heard"),
        select=_LISTS,
    ),
    "stream_recs_batches": with_(
        EVENTS,
        "before AS (SELECT * FROM ev WHERE event_id % 4 = 0)",
        "heard AS (SELECT * FROM ev WHERE event_type NOT IN ('error', 'signup') AND event_id % 4 <> 0)",
        "one AS (SELECT * FROM heard WHERE event_id % 4 <> 3)",
        "two AS (SELECT * FROM heard WHERE event_id % 4 = 3)",
        "rated1 AS (SELECT * FROM one UNION ALL SELECT * FROM before)",
        "rated2 AS (SELECT * FROM heard UNION ALL SELECT * FROM before)",
        SIMS,
        *_scored_batch(1, "one", "one", "rated1"),
        *_scored_batch(2, "two", "heard", "rated2"),
        """scored AS (SELECT * FROM scored2
          UNION ALL SELECT * FROM scored1 WHERE user_id NOT IN (SELECT user_id FROM two))""",
        """ranked AS (SELECT user_id, product_id, score, CAST(row_number() OVER (
          PARTITION BY user_id ORDER BY score DESC, product_id) AS INT) AS rank FROM scored)""",
        "rated_users AS (SELECT DISTINCT user_id FROM heard)",
        select=_LISTS,
    ),
    "stream_collected": with_(
        EVENTS,
        _log(),
        select="""SELECT 'INFO app - PRODUCT_RATING_PREFIX:' || value
          || CASE WHEN kind = 'signup' THEN '' ELSE ' ' END AS value
          FROM lines WHERE value IS NOT NULL""",
    ),
    "stream_payloads": with_(
        EVENTS, _log(), select="SELECT value FROM lines WHERE value IS NOT NULL"
    ),
    "stream_tail": with_(EVENTS, _log(), select="SELECT value FROM lines WHERE value IS NOT NULL"),
    "stream_offsets": with_(
        EVENTS.replace("FROM events)", "FROM events WHERE event_id % 2 = 1)"),
        _log(),
        select="SELECT value FROM lines WHERE value IS NOT NULL",
    ),
    "stream_topic": with_(EVENTS, _log(), select="SELECT value FROM lines WHERE value IS NOT NULL"),
    "stream_quarantine": with_(
        EVENTS, _log(), select="SELECT value FROM lines WHERE kind = 'signup'"
    ),
}
