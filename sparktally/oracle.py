"""Independent SQL for the queries in `catalog`, on the same tables."""

from __future__ import annotations

from sparktally.sources.sample_tables import STOP_WORDS

_STOP = ", ".join("('" + w.replace("'", "''") + "')" for w in STOP_WORDS)

MOVIES = """movies AS (
  SELECT p_partkey AS movie_id, CASE WHEN p_partkey % 19 = 0 THEN 'Same Title' ELSE p_name END AS title, p_type || '|' || p_brand AS genres FROM part)"""
RATINGS = """ratings AS (
  SELECT o_custkey AS user_id, CASE WHEN l_orderkey % 53 = 0 THEN -l_partkey ELSE l_partkey END AS movie_id, ceil(l_quantity / 5) / 2 AS rating,
         l_shipdate AS day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
LINE_RATINGS = """ratings AS (
  SELECT CASE WHEN l_orderkey % 53 = 0 THEN -l_partkey ELSE l_partkey END AS movie_id, ceil(l_quantity / 5) / 2 AS rating, l_shipdate AS day
  FROM lineitem)"""
USERS = """users AS (
  SELECT c_custkey AS user_id,
         CASE WHEN c_custkey % 50 = 7 THEN 'x' WHEN c_custkey % 50 = 13 THEN 'm'
              WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         10 + c_custkey % 60 AS age, c_nationkey AS occupation_id
  FROM customer)"""
REVIEWS = """reviews AS (
  SELECT CASE WHEN d.doc_id % 31 <> 0 THEN d.doc_id END AS id, d.text AS review, d.source AS category, d.lang AS aspect,
         CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive'
              WHEN quality = 0 THEN 'neutral' END AS sentiment
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
WORDS = f"""words AS (
  SELECT id, category, aspect, sentiment, word FROM (
    SELECT id, category, aspect, sentiment,
           unnest(regexp_split_to_array(lower(review), '[ \\t\\r\\n",()*]+')) AS word
    FROM reviews) s
  WHERE word <> '' AND word NOT IN (SELECT w FROM (VALUES {_STOP}) v(w)))"""
COMMERCE_ORDERS = """co AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS purchase_ts,
         CASE WHEN o_orderkey % 37 <> 0
              THEN o_orderdate + to_days(CAST(o_orderkey % 120 AS INTEGER)) END AS carrier_ts
  FROM orders)"""
ITEMS = """items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
         CAST(round((l_extendedprice + floor(l_extendedprice * l_tax * 100.0) / 100.0) * 100.0)
              AS BIGINT) AS cents,
         l_shipdate AS shipping_limit
  FROM lineitem)"""
PRODUCTS = """products AS (
  SELECT p_partkey AS product_id, CASE WHEN p_partkey % 29 <> 0 THEN p_type END AS category
  FROM part)"""
EVENT_NUMBERS = """numbered AS (
  SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k FROM events)"""
SCORES = EVENT_NUMBERS + """, texts AS (
  SELECT event_id // 2 AS order_id,
         CASE k % 14 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 3 THEN '4.7'
                     WHEN 4 THEN '0' WHEN 5 THEN '6' WHEN 6 THEN ' 5 ' WHEN 7 THEN '3' WHEN 8 THEN '4'
                     WHEN 9 THEN '5' WHEN 10 THEN '1e2' WHEN 11 THEN '.5' WHEN 12 THEN '99999999999'
                     ELSE '+2' END AS text
  FROM numbered), scores AS (
  SELECT order_id, text,
         TRY_CAST(trunc(TRY_CAST(trim(text) AS DOUBLE)) AS INTEGER) AS score FROM texts)"""
DETECTIONS = EVENT_NUMBERS + """, all_boxes AS (
  SELECT event_id, i, k, ((k * i * 7) % 101) / 100.0 AS confidence,
         CASE WHEN (k + i) % 3 = 0 THEN 'car' ELSE 'person' END AS class
  FROM numbered, (VALUES (1), (2), (3), (4)) b(i) WHERE i <= k % 5),
boxes AS (
  SELECT event_id, i, CAST(confidence AS DOUBLE) AS confidence, k,
         row_number() OVER (PARTITION BY event_id ORDER BY i) AS person
  FROM all_boxes WHERE class = 'person' AND confidence >= 0.4),
records AS (
  SELECT n.event_id, 'cam' || n.user_id AS camera_id, n.ts,
         strftime(n.ts, '%Y-%m-%dT%H:%M:%S') ||
           CASE WHEN microsecond(n.ts) % 1000000 = 0 THEN ''
                ELSE '.' || lpad(CAST(microsecond(n.ts) % 1000000 AS VARCHAR), 6, '0') END
           || '+00:00' AS iso,
         CAST(count(b.i) AS INTEGER) AS person_count
  FROM numbered n LEFT JOIN boxes b ON n.event_id = b.event_id
  GROUP BY n.event_id, n.user_id, n.ts)"""
SCORED_BOXES = """
WITH sized AS (
  SELECT page_id, strlen(html) AS n FROM pages WHERE page_id % 10 NOT IN (3, 5, 7, 9)),
drawn AS (
  SELECT page_id, i, 16 * i - 15 AS x, 3 + n * i % 11 AS w, 3 + (n * 7 + i * 5) % 27 AS h, 40 + (n * 7 + i * 13) % 216 AS grey
  FROM sized, (VALUES (1), (2), (3), (4)) b(i) WHERE i <= n % 5),
found AS (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i) AS person FROM drawn WHERE h > w AND grey / 255.0 >= 0.4)
SELECT CAST(s.page_id AS VARCHAR) AS frame_id, 'cam' || (s.page_id % 4) AS camera_id,
       '2024-01-01T00:00:00+00:00' AS timestamp,
       CAST(count(f.i) OVER (PARTITION BY s.page_id) AS INTEGER) AS person_count,
       CAST(f.person AS INTEGER) AS person,
       CAST(f.x AS DOUBLE) AS x1, CAST(CASE WHEN f.i IS NOT NULL THEN 1 END AS DOUBLE) AS y1,
       CAST(f.x + f.w AS DOUBLE) AS x2, CAST(f.h + 1 AS DOUBLE) AS y2,
       round(CAST(f.grey AS DOUBLE) / 255.0, 4) AS confidence
FROM sized s LEFT JOIN found f ON s.page_id = f.page_id"""


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + "\n"


def _gender_pivot(keys: str) -> str:
    return _with(MOVIES, RATINGS, USERS) + f"""
SELECT {keys},
       coalesce(avg(rating) FILTER (upper(gender) = 'M'), 0.0) AS male_avg,
       coalesce(avg(rating) FILTER (upper(gender) = 'F'), 0.0) AS female_avg
FROM ratings JOIN users USING (user_id) JOIN movies USING (movie_id) GROUP BY {keys}"""


def _product_sales(fan_out: bool) -> str:
    valid = SCORES + ", valid AS (SELECT order_id, score FROM scores WHERE score IS NOT NULL)"
    if fan_out:
        return _with(ITEMS, PRODUCTS, valid) + """, stats AS (
SELECT product_id, category, count(*) AS total_sold, avg(score) AS avg_rating
FROM items LEFT JOIN products USING (product_id) JOIN valid USING (order_id)
GROUP BY product_id, category)"""
    return _with(ITEMS, PRODUCTS, valid) + """, pairs AS (
SELECT DISTINCT order_id, product_id FROM items), rated AS (
SELECT product_id, avg(score) AS avg_rating FROM pairs JOIN valid USING (order_id) GROUP BY product_id
), sold AS (SELECT product_id, count(*) AS total_sold FROM items GROUP BY product_id), stats AS (
SELECT product_id, category, total_sold, avg_rating
FROM sold LEFT JOIN rated USING (product_id) LEFT JOIN products USING (product_id))"""


_STATS = "\nSELECT product_id, category, total_sold, avg_rating FROM stats"
_BEST = _STATS + " ORDER BY total_sold DESC, product_id LIMIT 10"

_SELLERS = _with(ITEMS) + """, totals AS (
SELECT seller_id, sum(cents) AS cents, count(DISTINCT order_id) AS total_orders,
       count(*) AS total_items_sold
FROM items GROUP BY seller_id)
SELECT seller_id, CAST(cents AS DOUBLE) / 100.0 AS total_revenue, total_orders, total_items_sold,
       rank() OVER (ORDER BY cents DESC) AS rank_by_revenue,
       rank() OVER (ORDER BY total_orders DESC) AS rank_by_orders
FROM totals"""

_ORDERS_BY_MONTH = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(DISTINCT o_orderkey) AS total_orders
FROM orders GROUP BY 1, 2"""

_ASPECTS = _with(REVIEWS) + """
SELECT aspect, sentiment, count(id) AS n FROM reviews
WHERE sentiment IN ('positive', 'negative') GROUP BY aspect, sentiment"""

_DELAYS = _with(ITEMS, COMMERCE_ORDERS) + """, delays AS (
SELECT seller_id, date_diff('day', CAST(shipping_limit AS DATE), CAST(carrier_ts AS DATE)) AS d
FROM items LEFT JOIN co USING (order_id))"""

_WINDOWS = _with(DETECTIONS) + """, windows AS (
SELECT camera_id, date_trunc('hour', ts) AS w, count(*) AS frames,
       CAST(sum(person_count) AS BIGINT) AS people, avg(person_count) AS avg_people,
       max(person_count) AS max_people
FROM records GROUP BY 1, 2)
SELECT camera_id, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(w + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
       frames, people, avg_people, max_people
FROM windows"""

_DETECTION_BOXES = _with(DETECTIONS) + """
SELECT CAST(r.event_id AS VARCHAR) AS frame_id, camera_id, iso AS timestamp, person_count,
       CAST(person AS INTEGER) AS person,
       CAST(i * 10 AS DOUBLE) AS x1, CAST(i * 5 AS DOUBLE) AS y1,
       CAST(i * 10 + k AS DOUBLE) AS x2, CAST(i * 5 + k AS DOUBLE) AS y2, confidence
FROM records r LEFT JOIN boxes b ON r.event_id = b.event_id"""

_SCHEMA_TABLES = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                 ("c_acctbal", "double"), ("c_mktsegment", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                 ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
               ("event_type", "string"), ("value", "double"), ("props", "string")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"),
               ("o_orderpriority", "string")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"),
             ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")],
}


def _schema_report() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, {i} AS position, '{column}' AS column_name, "
        f"'{kind}' AS type, count({column}) AS n_values FROM {table}"
        for table, columns in _SCHEMA_TABLES.items()
        for i, (column, kind) in enumerate(columns, 1))


_PROFILE = """, valued AS (
SELECT order_id, sum(cents) AS cents FROM items GROUP BY order_id), profile AS (
SELECT customer_id, count(*) AS n_orders, coalesce(sum(cents), 0) AS cents,
       max(year(purchase_ts) * 12 + month(purchase_ts))
         - min(year(purchase_ts) * 12 + month(purchase_ts)) + 1 AS months
FROM co LEFT JOIN valued USING (order_id) GROUP BY customer_id), rated AS (
SELECT customer_id, n_orders, CAST(cents AS DOUBLE) / 100.0 / n_orders AS value,
       n_orders / CAST(months AS DOUBLE) AS frequency FROM profile)"""
_GENDER_LONG = _with(MOVIES, RATINGS, USERS) + """
SELECT title, gender, avg(rating) AS avg_rating
FROM ratings JOIN users USING (user_id) JOIN movies USING (movie_id)
GROUP BY movie_id, title, gender"""
_OCCUPATIONS = _with(RATINGS, USERS) + """
SELECT n_name AS occupation, avg(rating) AS avg_rating, count(*) AS n_ratings
FROM ratings JOIN users USING (user_id) JOIN nation ON occupation_id = n_nationkey GROUP BY n_name"""
ORACLE: dict[str, str] = {
    "movie_rating_summary": _with(MOVIES, LINE_RATINGS) + """
SELECT title, avg(rating) AS avg_rating, count(*) AS n_ratings
FROM ratings JOIN movies USING (movie_id) GROUP BY movie_id, title""",
    "top_rated_movie": _with(MOVIES, LINE_RATINGS) + """
SELECT title, avg(rating) AS avg_rating, count(*) AS n_ratings
FROM ratings JOIN movies USING (movie_id) GROUP BY movie_id, title
HAVING count(*) >= 5 ORDER BY avg_rating DESC, title, movie_id LIMIT 1""",
    "top_rated_movies": _with(MOVIES, LINE_RATINGS) + """
SELECT avg(rating) AS avg_rating, title, count(*) AS n_ratings,
       CAST(row_number() OVER (ORDER BY avg(rating) DESC, title, movie_id) AS INTEGER) AS place
FROM ratings JOIN movies USING (movie_id) GROUP BY movie_id, title
HAVING count(*) >= 5 ORDER BY avg_rating DESC, title, movie_id LIMIT 10""",
    "genre_rating_summary": _with(MOVIES, LINE_RATINGS) + """
SELECT genre, avg(rating) AS avg_rating, count(*) AS n_ratings,
       CAST(row_number() OVER (ORDER BY avg(rating) DESC, genre) AS INTEGER) AS place
FROM ratings JOIN (SELECT movie_id, unnest(string_split(genres, '|')) AS genre FROM movies) g
USING (movie_id) GROUP BY genre""",
    "genre_rating_summary_float": _with(MOVIES, LINE_RATINGS) + """
SELECT genre, CAST(CAST(avg(rating) AS FLOAT) AS DOUBLE) AS avg_rating, count(*) AS n_ratings
FROM ratings JOIN (SELECT movie_id, unnest(string_split(genres, '|')) AS genre FROM movies) g
USING (movie_id) GROUP BY genre""",
    "movie_gender_pivot": _gender_pivot("title"),
    "movie_gender_pivot_by_id": _gender_pivot("movie_id, title"),
    "movie_gender_long": _GENDER_LONG,
    "movie_age_pivot": _with(MOVIES, RATINGS, USERS) + """
SELECT coalesce(title, CAST(movie_id AS VARCHAR)) AS title, avg(rating) FILTER (age <= 18) AS age_0_18,
       avg(rating) FILTER (age > 18 AND age <= 35) AS age_18_35,
       avg(rating) FILTER (age > 35 AND age <= 50) AS age_35_50,
       avg(rating) FILTER (age > 50) AS age_50_plus
FROM ratings JOIN users USING (user_id) LEFT JOIN movies USING (movie_id) GROUP BY 1""",
    "movie_age_long": _with(MOVIES, RATINGS, USERS) + """, banded AS (
SELECT movie_id, title, rating,
       CASE WHEN age < 18 THEN 'Under18' WHEN age <= 25 THEN '18-25' WHEN age <= 35 THEN '26-35'
            WHEN age <= 45 THEN '36-45' WHEN age <= 50 THEN '46-50' ELSE '50+' END AS band
FROM ratings JOIN users USING (user_id) JOIN movies USING (movie_id))
SELECT title, band, avg(rating) AS avg_rating FROM banded GROUP BY movie_id, title, band""",
    "occupation_rating_summary": _OCCUPATIONS,
    "yearly_rating_summary": _with(LINE_RATINGS) + """
SELECT CAST(year(day) AS INTEGER) AS year, avg(rating) AS avg_rating, count(*) AS n_ratings
FROM ratings GROUP BY 1""",
    "ratings_text_round_trip": _with(RATINGS) + """
SELECT CAST(year(day) AS INTEGER) AS year, count(*) AS n_ratings, sum(rating) AS total
FROM ratings WHERE (user_id + movie_id) % 97 <> 0 AND (user_id + movie_id) % 89 <> 0 AND (user_id + movie_id) % 83 <> 0
GROUP BY 1""",
    "rating_rejects": _with(RATINGS) + """
SELECT count(*) AS n_rows, count(*) FILTER ((user_id + movie_id) % 89 = 0) AS n_short,
       count(*) FILTER ((user_id + movie_id) % 89 <> 0 
                        AND ((user_id + movie_id) % 97 = 0 OR (user_id + movie_id) % 83 = 0)) AS n_bad_rating,
       count(*) FILTER ((user_id + movie_id) % 89 <> 0 AND (user_id + movie_id) % 97 <> 0
                        AND (user_id + movie_id) % 83 <> 0) AS n_kept
FROM ratings""",
    "message_rejects": _with(DETECTIONS) + """
SELECT CASE WHEN event_id % 41 = 0 THEN 'malformed' ELSE 'record' END AS kind, count(*) AS n,
       CAST(sum(CASE WHEN event_id % 41 <> 0 THEN person_count END) AS BIGINT) AS people,
       (SELECT count(*) FROM events) AS n_rows, (SELECT count(*) FROM events WHERE event_id % 41 = 0) AS n_malformed
FROM records GROUP BY 1""",
    "movie_gender_long_by_layout": _GENDER_LONG,
    "occupation_summary_by_layout": _OCCUPATIONS,
    "movie_means_between_loads": _with(LINE_RATINGS) + """
SELECT movie_id, avg(rating) AS avg_rating, count(*) AS n_ratings FROM ratings GROUP BY movie_id""",
    "lines_round_trip": _with(MOVIES, LINE_RATINGS) + """, means AS (
SELECT genre, CAST(sum(rating * 2) AS BIGINT) AS halves, count(*) AS n
FROM ratings JOIN (SELECT movie_id, unnest(string_split(genres, '|')) AS genre FROM movies) g USING (movie_id) GROUP BY genre),
cents AS (SELECT *, (100 * halves + n) // (2 * n) AS c FROM means)
SELECT genre || ',' || (c // 100) || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') || ',' || n AS value,
       CAST(1 AS BIGINT) AS n_files, true AS refused FROM cents""",
    "movies_text_round_trip": _with(MOVIES) + """, lines AS (
SELECT CAST(movie_id AS VARCHAR) AS movie_id, title, genres, movie_id % 5 = 0 AS comma,
       CASE WHEN movie_id % 5 = 0 THEN title || ', The' ELSE title END AS full_title FROM movies)
SELECT 'first_comma' AS dialect, movie_id, full_title || ', ' || genres AS title, NULL AS genres FROM lines
UNION ALL SELECT 'three_way', movie_id, title,
       CASE WHEN comma THEN 'The, ' || genres ELSE genres END FROM lines
UNION ALL SELECT 'last_comma', movie_id, full_title, genres FROM lines
UNION ALL SELECT 'csv', movie_id, full_title, genres FROM lines""",
    "users_text_round_trip": _with(USERS) + """, aged AS (
SELECT occupation_id, CASE WHEN user_id % 31 <> 0 THEN age END AS age FROM users)
SELECT n_name AS occupation,
       CASE WHEN age IS NULL THEN NULL WHEN age < 18 THEN 'Under18' WHEN age <= 25 THEN '18-25'
            WHEN age <= 35 THEN '26-35' WHEN age <= 45 THEN '36-45' WHEN age <= 50 THEN '46-50'
            ELSE '50+' END AS band, count(*) AS n_users
FROM aged JOIN nation ON occupation_id = n_nationkey GROUP BY 1, 2""",
    "clean_review_tokens": _with(REVIEWS, WORDS) + """
SELECT id AS review_id, word FROM words""",
    "frequent_words": _with(REVIEWS, WORDS) + """
SELECT word, count(*) AS freq FROM words GROUP BY word HAVING count(*) > 500""",
    "frequent_words_beyond_list": """
WITH listed AS (
  SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[ \t\r\n",()*]+')) AS word FROM benchmark),
words AS (
  SELECT unnest(regexp_split_to_array(lower(text), '[ \t\r\n",()*]+')) AS word FROM documents)
SELECT word, count(*) AS freq FROM words
WHERE word <> '' AND word NOT IN (SELECT word FROM listed) GROUP BY word HAVING count(*) > 20""",
    "clean_tokens_word_file": """
WITH listed AS (
  SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[ \t\r\n",()*]+')) AS word FROM benchmark),
words AS (
  SELECT source, unnest(regexp_split_to_array(lower(text), '[ \t\r\n",()*]+')) AS word FROM documents)
SELECT source AS category, count(*) AS n_words FROM words
WHERE word <> '' AND word NOT IN (SELECT word FROM listed) GROUP BY source""",
    "reviews_by_category": "SELECT source AS category, count(*) FILTER (doc_id % 31 <> 0) AS n FROM documents GROUP BY source",
    "reviews_by_aspect": "SELECT lang AS aspect, count(DISTINCT CASE WHEN doc_id % 31 <> 0 THEN doc_id END) AS n FROM documents GROUP BY lang",
    "aspect_sentiment_ranking": f"""SELECT *, CAST(row_number() OVER (ORDER BY sentiment, n DESC, aspect) AS INTEGER)
       AS place FROM ({_ASPECTS}) a""",
    "top_aspect_by_sentiment": f"""SELECT aspect, sentiment, n FROM ({_ASPECTS}) c
QUALIFY row_number() OVER (PARTITION BY sentiment ORDER BY n DESC, aspect) = 1""",
    "sentiment_split_round_trip": _ASPECTS,
    "top_words_by_category_sentiment": _with(REVIEWS, WORDS) + """, counts AS (
SELECT category, sentiment, word, count(*) AS freq FROM words
WHERE sentiment IN ('positive', 'negative') GROUP BY category, sentiment, word), top AS (
SELECT *, row_number() OVER (PARTITION BY category, sentiment ORDER BY freq DESC, word) AS rk FROM counts)
SELECT category, sentiment, string_agg(word || ':' || freq, ' ' ORDER BY rk) AS top_words
FROM top WHERE rk <= 5 GROUP BY category, sentiment""",
    "top_words_by_category": _with(REVIEWS, WORDS) + """, counts AS (
SELECT category, word, count(*) AS freq FROM words GROUP BY category, word), top AS (
SELECT *, row_number() OVER (PARTITION BY category ORDER BY freq DESC, word) AS rk FROM counts)
SELECT category, string_agg(word || ':' || freq, ' ' ORDER BY rk) AS top_words
FROM top WHERE rk <= 5 GROUP BY category""",
    "top_words_by_category_aspect_sentiment": _with(REVIEWS, WORDS) + """, counts AS (
SELECT category, aspect, sentiment, word, count(*) AS freq FROM words GROUP BY ALL)
SELECT category, aspect, sentiment, word, freq FROM counts
QUALIFY row_number() OVER (PARTITION BY category, aspect, sentiment ORDER BY freq DESC, word) <= 5""",
    "tfidf_top_words": _with(REVIEWS, WORDS) + """, counts AS (
SELECT category, aspect, word, count(*) AS c FROM words GROUP BY ALL), sizes AS (
SELECT category, aspect, sum(c) AS s FROM counts GROUP BY ALL), dfs AS (
SELECT word, count(*) AS df FROM counts GROUP BY word), scored AS (
SELECT category, aspect, word, CAST(c AS DOUBLE) / s AS tf,
       (CAST(c AS DOUBLE) / s) * ln((SELECT count(*) FROM sizes) / CAST(df AS DOUBLE)) AS score
FROM counts JOIN sizes USING (category, aspect) JOIN dfs USING (word))
SELECT category, aspect, word, round(tf, 9) AS tf, round(score, 9) AS tfidf FROM scored
QUALIFY row_number() OVER (PARTITION BY category, aspect ORDER BY score DESC, word) <= 5""",
    "reviews_delimited_round_trip": _with(REVIEWS) + """
SELECT aspect, sentiment, count(id) AS n, CAST(sum(length(review)) AS BIGINT) AS n_chars
FROM reviews GROUP BY aspect, sentiment""",
    "dataset_schema_report": _schema_report(),
    "inferred_csv_round_trip": _ORDERS_BY_MONTH,
    "entity_totals": """
SELECT (SELECT count(DISTINCT o_orderkey) FROM orders) AS total_orders,
       (SELECT count(DISTINCT c_custkey) FROM customer) AS total_customers,
       (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS total_sellers""",
    "orders_by_country": """
SELECT n_name AS country, count(DISTINCT o_orderkey) AS total_orders,
       CAST(row_number() OVER (ORDER BY count(DISTINCT o_orderkey) DESC, n_name NULLS FIRST) AS INTEGER) AS place
FROM orders LEFT JOIN (
  SELECT c_custkey, CASE WHEN c_custkey % 41 <> 0 THEN n_name END AS n_name
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey) c ON o_custkey = c_custkey
GROUP BY n_name""",
    "orders_by_month": f"""SELECT *, CAST(row_number() OVER (ORDER BY year, month DESC) AS INTEGER) AS place
FROM ({_ORDERS_BY_MONTH}) m""",
    "review_score_distribution": _with(SCORES) + """
SELECT score, count(*) AS total_reviews, avg(score) AS avg_score,
       CAST(row_number() OVER (ORDER BY score) AS INTEGER) AS place
FROM scores WHERE score BETWEEN 1 AND 5 GROUP BY score""",
    "review_overall": _with(SCORES) + """
SELECT count(*) AS n_rows, count(*) FILTER (score BETWEEN 1 AND 5) AS n_valid,
       count(*) FILTER (text IS NULL) AS n_null,
       count(*) FILTER (text IS NOT NULL AND score IS NULL) AS n_not_numeric,
       count(*) FILTER (score IS NOT NULL AND score NOT BETWEEN 1 AND 5) AS n_out_of_range,
       avg(score) FILTER (score BETWEEN 1 AND 5) AS avg_score
FROM scores""",
    "category_revenue": _with(ITEMS, PRODUCTS) + """
SELECT category, CAST(sum(cents) AS DOUBLE) / 100.0 AS total_revenue
FROM items LEFT JOIN orders ON order_id = o_orderkey LEFT JOIN products USING (product_id)
WHERE year(o_orderdate) = 1998 GROUP BY category""",
    "product_sales_and_rating": _product_sales(True) + _STATS,
    "product_sales_without_fan_out": _product_sales(False) + _STATS,
    "best_selling_product": _product_sales(True) + _BEST,
    "best_seller_true": _product_sales(False) + _BEST,
    "seller_ranking": _SELLERS.replace("FROM totals", """,
       CAST(row_number() OVER (ORDER BY cents DESC, seller_id) AS INTEGER) AS place
FROM totals ORDER BY place LIMIT 20"""),
    "seller_ranking_all": _SELLERS,
    "global_rank": """
SELECT l_orderkey AS order_id, count(*) AS n_items,
       rank() OVER (ORDER BY count(*) DESC) AS rank_by_items
FROM lineitem GROUP BY l_orderkey""",
    "delivery_delay": _DELAYS + """
SELECT seller_id, count(*) AS n_items, count(*) FILTER (d < 0) AS n_early,
       count(*) FILTER (d = 0) AS n_on_time, count(*) FILTER (d > 0) AS n_late,
       count(*) FILTER (d IS NULL) AS n_open, avg(d) AS avg_delay_days
FROM delays GROUP BY seller_id""",
    "delivery_performance": _DELAYS + """
SELECT CASE WHEN d IS NULL THEN 'open' WHEN d < 0 THEN 'early' WHEN d = 0 THEN 'on_time'
            ELSE 'late' END AS performance, count(*) AS n_items, avg(d) AS avg_delay_days
FROM delays GROUP BY 1""",
    "customer_value_quartiles": _with(ITEMS, COMMERCE_ORDERS) + _PROFILE + """
SELECT customer_id, CAST(ntile(4) OVER (ORDER BY value, customer_id) AS INTEGER) AS tile FROM rated""",
    "customer_segments_by_quantile": _with(ITEMS, COMMERCE_ORDERS) + _PROFILE + """, cuts AS (
SELECT s, list_sort(list(n_orders))[CAST(ceil(count(*) * s) AS BIGINT)] AS o,
       list_sort(list(value))[CAST(ceil(count(*) * s) AS BIGINT)] AS v,
       list_sort(list(frequency))[CAST(ceil(count(*) * s) AS BIGINT)] AS f
FROM rated, (VALUES (CAST(0.25 AS DOUBLE)), (0.5), (0.75)) x(s) GROUP BY s)
SELECT CAST((SELECT count(*) FROM cuts WHERE n_orders > o) AS INTEGER) AS order_level,
       CAST((SELECT count(*) FROM cuts WHERE value > v) AS INTEGER) AS value_level,
       CAST((SELECT count(*) FROM cuts WHERE frequency > f) AS INTEGER) AS frequency_level,
       count(*) AS n_customers, avg(n_orders) AS avg_orders
FROM rated GROUP BY 1, 2, 3""",
    "price_quantile_sketch": """
SELECT share, (SELECT count(*) FROM lineitem) AS n, true AS near
FROM (VALUES (CAST(0.1 AS DOUBLE)), (0.25), (0.5), (0.75), (0.9)) s(share)""",
    "distinct_orders_rolled_up": """
WITH placed AS (
  SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS year, country
  FROM orders LEFT JOIN (
    SELECT c_custkey, CASE WHEN c_custkey % 41 <> 0 THEN n_name END AS country
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey) c ON o_custkey = c_custkey)
SELECT 'country' AS level, country AS key, count(DISTINCT o_orderkey) AS n_exact, true AS near FROM placed GROUP BY country
UNION ALL SELECT 'year', year, count(DISTINCT o_orderkey), true FROM placed GROUP BY year
UNION ALL SELECT 'all', 'all', count(DISTINCT o_orderkey), true FROM placed""",
    "customer_segments": _with(ITEMS, COMMERCE_ORDERS) + """, valued AS (
SELECT order_id, sum(cents) AS cents FROM items GROUP BY order_id), profile AS (
SELECT customer_id, count(*) AS n_orders, coalesce(sum(cents), 0) AS cents,
       max(year(purchase_ts) * 12 + month(purchase_ts))
         - min(year(purchase_ts) * 12 + month(purchase_ts)) + 1 AS months
FROM co LEFT JOIN valued USING (order_id) GROUP BY customer_id)
SELECT CAST(CASE WHEN n_orders <= 8 THEN 0 WHEN n_orders <= 12 THEN 1 ELSE 2 END AS INTEGER) AS order_level,
       CAST(CASE WHEN CAST(cents AS DOUBLE) / 100.0 / n_orders <= 100000.0 THEN 0
                 WHEN CAST(cents AS DOUBLE) / 100.0 / n_orders <= 150000.0 THEN 1 ELSE 2 END AS INTEGER) AS value_level,
       CAST(CASE WHEN n_orders / CAST(months AS DOUBLE) <= CAST(0.12 AS DOUBLE) THEN 0
                 WHEN n_orders / CAST(months AS DOUBLE) <= CAST(0.16 AS DOUBLE) THEN 1 ELSE 2 END AS INTEGER) AS frequency_level,
       count(*) AS n_customers, avg(n_orders) AS avg_orders
FROM profile GROUP BY 1, 2, 3""",
    "frame_paths": """
SELECT path, row_number() OVER (ORDER BY path) AS place FROM (
  SELECT '/frames/' || page_id || CASE page_id % 3 WHEN 0 THEN '.JPG' WHEN 1 THEN '.jpeg' ELSE '.png' END AS path FROM pages) p""",
    "frames_from_files": """
SELECT kind, md5(html) AS content_md5, CAST(strlen(html) AS BIGINT) AS length
FROM pages, (VALUES ('batch'), ('stream')) k(kind)""",
    "frames_to_messages": """
WITH files AS (
  SELECT page_id, html, '/frames/' || page_id ||
         CASE page_id % 3 WHEN 0 THEN '.JPG' WHEN 1 THEN '.jpeg' ELSE '.png' END AS path FROM pages),
digests AS (
  SELECT *, md5(path || '|2024-01-01 00:00:00|' || strlen(html)) AS h FROM files)
SELECT h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] AS frame_id,
       'cam01' AS camera_id, '2024-01-01T00:00:00+00:00' AS timestamp,
       CASE page_id % 3 WHEN 0 THEN 'jpg' WHEN 1 THEN 'jpeg' ELSE 'png' END AS image_format,
       to_base64(encode(html)) AS image_data
FROM digests""",
    "detect_people": SCORED_BOXES,
    "undecodable_frames": """
SELECT CAST(page_id AS VARCHAR) AS frame_id, 'cam' || (page_id % 4) AS camera_id, '2024-01-01T00:00:00+00:00' AS timestamp,
       CASE page_id % 10 WHEN 3 THEN 'no base64' WHEN 5 THEN 'truncated' WHEN 7 THEN 'foreign' ELSE 'damaged' END AS fault
FROM pages WHERE page_id % 10 IN (3, 5, 7, 9)""",
    "frames_to_store": SCORED_BOXES,
    "latest_detections": _with(DETECTIONS) + """
SELECT CAST(event_id AS VARCHAR) AS frame_id, camera_id, iso AS timestamp, person_count,
       row_number() OVER (ORDER BY iso DESC, CAST(event_id AS VARCHAR)) AS place FROM records""",
    "detection_boxes": _DETECTION_BOXES,
    "messages_by_reader": _with(DETECTIONS) + """
SELECT reader, count(*) AS n, count(DISTINCT event_id) AS n_frames, CAST(sum(person_count) AS BIGINT) AS people
FROM records, (VALUES ('all', 0), ('new', 1)) r(reader, first) WHERE event_id % 3 >= first GROUP BY reader""",
    "store_detections": _DETECTION_BOXES,
    "store_detections_once": _DETECTION_BOXES,
    "detections_total": "SELECT count(*) AS total FROM events",
    "people_per_window": _WINDOWS,
    "people_per_window_stream": _WINDOWS,
}
