"""The SQL each registered query is checked against, over the whole tables."""

from __future__ import annotations

from checks.queries import MIN_SUPPORT, REVENUE_YEAR
from checks.star import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

_MOVIES = """movies AS (
    SELECT CASE WHEN p_size > 40 THEN -1 - p_partkey ELSE p_partkey END AS movie_id, p_name AS title,
           p_type || '|' || p_brand AS genres
    FROM part)"""
_ALL_USERS = """all_users AS (
    SELECT o_orderkey AS user_id, o_orderpriority,
           CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' ELSE 'other' END AS gender,
           o_custkey % 80 AS age
    FROM orders)"""
_USERS = _ALL_USERS + """, users AS (
    SELECT * REPLACE (CASE o_orderpriority WHEN '5-LOW' THEN -1 - user_id ELSE user_id END AS user_id) FROM all_users)"""
_REVIEWS = """reviews AS (
    SELECT d.doc_id AS id, d.text AS review, d.lang AS category, d.source AS aspect,
           CASE l.quality WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' ELSE 'neutral' END AS sentiment
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
_WORDS = """words AS (
    SELECT id, category, sentiment, word
    FROM (SELECT id, category, sentiment, unnest(string_split(lower(review), ' ')) AS word FROM reviews)
    WHERE word <> '')"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_MOVIE_OUTER = """movie_outer AS (
    SELECT r.movie_id, coalesce(m.title, 'Chua_co_ten') AS title, r.avg_rating, r.n_ratings
    FROM (SELECT l_partkey AS movie_id, avg(l_quantity) AS avg_rating, count(*) AS n_ratings
          FROM lineitem GROUP BY l_partkey) r
    LEFT JOIN movies m ON r.movie_id = m.movie_id)"""
_PARTS = """parts AS (
    SELECT l_partkey AS movie_id, l_quantity AS rating FROM lineitem
    UNION ALL SELECT p_partkey, CAST(p_size AS DOUBLE) FROM part)"""
_MOVIE_INNER = (
    _PARTS
    + """, movie_inner AS (
    SELECT m.movie_id, m.title, avg(r.rating) AS avg_rating, count(*) AS n_ratings
    FROM parts r JOIN movies m ON r.movie_id = m.movie_id GROUP BY m.movie_id, m.title)"""
)
_GENRES = """genre_avg AS (
    SELECT genre, avg(l_quantity) AS avg_rating, count(*) AS n_ratings
    FROM (SELECT l.l_quantity, unnest(string_split(m.genres, '|')) AS genre
          FROM lineitem l JOIN movies m ON l.l_partkey = m.movie_id)
    GROUP BY genre)"""
_GENDER_ZERO = """gender_zero AS (
    SELECT m.movie_id, m.title,
           coalesce(avg(l.l_quantity) FILTER (WHERE u.gender = 'M'), 0.0) AS avg_male,
           coalesce(avg(l.l_quantity) FILTER (WHERE u.gender = 'F'), 0.0) AS avg_female
    FROM lineitem l JOIN all_users u ON l.l_orderkey = u.user_id JOIN movies m ON l.l_partkey = m.movie_id
    WHERE u.gender IN ('M', 'F') GROUP BY m.movie_id, m.title)"""
_GENDER_NULL = """gender_null AS (
    SELECT l.l_partkey AS movie_id, coalesce(m.title, 'Unknown Movie') AS title,
           avg(l.l_quantity) FILTER (WHERE u.gender = 'M') AS avg_male,
           avg(l.l_quantity) FILTER (WHERE u.gender = 'F') AS avg_female
    FROM lineitem l LEFT JOIN users u ON l.l_orderkey = u.user_id LEFT JOIN movies m ON l.l_partkey = m.movie_id
    GROUP BY l.l_partkey, m.title)"""
_AGE4 = """age4 AS (
    SELECT m.movie_id, m.title,
           avg(l.l_quantity) FILTER (WHERE u.age <= 18) AS avg_0_18,
           avg(l.l_quantity) FILTER (WHERE u.age > 18 AND u.age <= 35) AS avg_18_35,
           avg(l.l_quantity) FILTER (WHERE u.age > 35 AND u.age <= 50) AS avg_35_50,
           avg(l.l_quantity) FILTER (WHERE u.age > 50) AS avg_50_plus
    FROM lineitem l JOIN all_users u ON l.l_orderkey = u.user_id JOIN movies m ON l.l_partkey = m.movie_id
    WHERE u.o_orderpriority <> '4-NOT SPECIFIED' GROUP BY m.movie_id, m.title)"""
_SEVEN = {
    "under_18": "u.age < 18",
    "18_24": "u.age >= 18 AND u.age <= 24",
    "25_34": "u.age > 24 AND u.age <= 34",
    "35_44": "u.age > 34 AND u.age <= 44",
    "45_49": "u.age > 44 AND u.age <= 49",
    "50_55": "u.age > 49 AND u.age <= 55",
    "56_plus": "u.age > 55",
}
_SEVEN_LABELS = ["<18", "18-24", "25-34", "35-44", "45-49", "50-55", "56+"]
_AGE7 = f"""age7 AS (
    SELECT l.l_partkey AS movie_id, coalesce(m.title, 'Unknown Movie') AS title,
           {", ".join(
               f"avg(l.l_quantity) FILTER (WHERE {c}) AS avg_{n}, count(*) FILTER (WHERE {c}) AS n_{n}"
               for n, c in _SEVEN.items())}
    FROM lineitem l LEFT JOIN users u ON l.l_orderkey = u.user_id LEFT JOIN movies m ON l.l_partkey = m.movie_id
    GROUP BY l.l_partkey, m.title)"""
_OCCUPATION = """occupation_avg AS (
    SELECT coalesce(n.n_name, 'Unknown') AS occupation, avg(l.l_quantity) AS avg_rating, count(*) AS n_ratings
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = CASE n.n_regionkey WHEN 4 THEN -1 - n.n_nationkey ELSE n.n_nationkey END
    GROUP BY 1)"""
_YEAR = """year_avg AS (
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, avg(l_quantity) AS avg_rating, count(*) AS n_ratings
    FROM lineitem GROUP BY 1)"""
_SCORES = """scores AS (
    SELECT event_id AS order_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS score FROM events)"""
_TOTALS = """totals AS (
    SELECT 'orders' AS metric, count(*) AS total FROM orders
    UNION ALL SELECT 'customers', count(*) FROM (SELECT DISTINCT o_custkey FROM orders)
    UNION ALL SELECT 'sellers', count(*) FROM (SELECT DISTINCT l_suppkey FROM lineitem))"""
_SEGMENTS = """segments AS (
    SELECT customer_id, n_orders, avg_order_value, orders_per_30_days,
           CASE WHEN n_orders = 1 THEN 'one-time'
                WHEN (n_orders >= 10 OR orders_per_30_days >= 1.0) AND avg_order_value >= 250000.0
                    THEN 'loyal high-value'
                WHEN n_orders >= 10 OR orders_per_30_days >= 1.0 THEN 'loyal'
                WHEN avg_order_value >= 250000.0 THEN 'high-value'
                ELSE 'occasional' END AS segment
    FROM (SELECT o_custkey AS customer_id, count(*) AS n_orders,
                 CAST(sum(CAST(o_totalprice AS DECIMAL(14, 2))) AS DOUBLE) / count(*) AS avg_order_value,
                 count(*) * CAST(30.0 AS DOUBLE)
                     / (date_diff('day', min(o_orderdate), max(o_orderdate)) + 1) AS orders_per_30_days
          FROM orders GROUP BY o_custkey))"""

# Limits are the least values that nine tenths of all customers do not exceed.
_SEGMENTS_BY_SHARE = (
    _SEGMENTS.replace("segments AS", "measured AS")
    + """, limits AS (
    SELECT max(n) FILTER (a = c) AS many, max(v) FILTER (b = c) AS high, max(f) FILTER (d = c) AS often
    FROM (SELECT n_orders AS n, avg_order_value AS v, orders_per_30_days AS f,
                 row_number() OVER (ORDER BY n_orders) AS a, row_number() OVER (ORDER BY avg_order_value) AS b,
                 row_number() OVER (ORDER BY orders_per_30_days) AS d, CAST(ceil(0.9 * count(*) OVER ()) AS BIGINT) AS c
          FROM measured)),
segments AS (
    SELECT customer_id, n_orders, avg_order_value, orders_per_30_days,
           CASE WHEN n_orders = 1 THEN 'one-time'
                WHEN (n_orders >= many OR orders_per_30_days >= often) AND avg_order_value >= high THEN 'loyal high-value'
                WHEN n_orders >= many OR orders_per_30_days >= often THEN 'loyal'
                WHEN avg_order_value >= high THEN 'high-value'
                ELSE 'occasional' END AS segment
    FROM measured, limits)"""
)


def _best(means: str, support: int, positive: str = "AND avg_rating > 0 ") -> str:
    return (
        f"best AS (SELECT * FROM {means} WHERE n_ratings >= {support} {positive}"
        "ORDER BY avg_rating DESC, CAST(movie_id AS VARCHAR) LIMIT 1)"
    )


def _top_words(where: str) -> str:
    return f"""top_words AS (
    SELECT category, CAST(rn AS INTEGER) AS "rank", word, cnt
    FROM (SELECT category, word, cnt, row_number() OVER (PARTITION BY category ORDER BY cnt DESC, word) AS rn
          FROM (SELECT category, word, count(*) AS cnt FROM words
                WHERE {where} AND word NOT IN ({_STOP}) GROUP BY category, word))
    WHERE rn <= 5)"""


def _top_aspects(sentiment: str) -> str:
    return (
        _with(_REVIEWS, f"c AS (SELECT aspect, count(id) AS cnt FROM reviews WHERE sentiment = '{sentiment}' GROUP BY aspect)")
        + "SELECT aspect, cnt FROM c WHERE cnt = (SELECT max(cnt) FROM c)"
    )


def _top_aspect(sentiment: str) -> str:
    return (
        _with(_REVIEWS)
        + f"SELECT aspect, count(id) AS cnt FROM reviews WHERE sentiment = '{sentiment}' "
        "GROUP BY aspect ORDER BY cnt DESC, aspect LIMIT 1"
    )


def _half_up(mean: str) -> str:
    return f"printf('%.2f', round(CAST({mean} AS DECIMAL(18, 9)), 2)::DOUBLE)"


def _age4_text(name: str) -> str:
    return f"CASE WHEN avg_{name} IS NULL THEN 'NA' ELSE {_half_up('avg_' + name)} END"


def _age7_text(label: str, name: str) -> str:
    value = f"CASE WHEN n_{name} > 0 THEN printf('%.2f (%d votes)', avg_{name}, n_{name}) ELSE 'N/A' END"
    return f"'{label}: ' || format('{{:<15}}', {value})"


def _table(counts: str, names: list[str]) -> str:
    """A bordered table: top, header, bar, one line per row, bottom."""
    columns = "abc"[: len(names)]
    widths = [f"greatest({len(n)}, max(length(CAST({c} AS VARCHAR))))" for n, c in zip(names, columns)]
    bars = "'+' || " + " || '+' || ".join(f"repeat('-', w.{c})" for c in columns) + " || '+'"
    line = lambda texts: "'|' || " + " || '|' || ".join(f"rpad({t}, w.{c}, ' ')" for t, c in zip(texts, columns)) + " || '|'"
    head, body = line([f"'{n}'" for n in names]), line([f"CAST(t.{c} AS VARCHAR)" for c in columns])
    return (
        f"WITH t AS ({counts}), w AS (SELECT {', '.join(f'CAST({x} AS INTEGER) AS {c}' for x, c in zip(widths, columns))} FROM t) "
        f"SELECT {bars} AS line FROM w UNION ALL SELECT {head} FROM w UNION ALL SELECT {bars} FROM w "
        f"UNION ALL SELECT {body} FROM t, w UNION ALL SELECT {bars} FROM w"
    )


_ORDER_COLUMNS = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}

SQL: dict[str, str] = {
    # Ratings
    "q_movie_avg_outer": _with(_MOVIES, _MOVIE_OUTER) + "SELECT * FROM movie_outer",
    "q_movie_avg_inner": _with(_MOVIES, _MOVIE_INNER) + "SELECT * FROM movie_inner",
    "q_best_movie": _with(_MOVIES, _MOVIE_OUTER, _best("movie_outer", MIN_SUPPORT)) + "SELECT * FROM best",
    "q_best_movie_of_zeros": _with(
        _MOVIES,
        _MOVIE_OUTER.replace("avg(l_quantity)", "avg(l_quantity * 0)"),
        _best("movie_outer", MIN_SUPPORT, ""),
    )
    + "SELECT * FROM best",
    "q_genre_avg": _with(_MOVIES, _GENRES) + "SELECT * FROM genre_avg",
    "q_gender_avg_zero": _with(_MOVIES, _ALL_USERS, _GENDER_ZERO) + "SELECT * FROM gender_zero",
    "q_gender_avg_null": _with(_MOVIES, _USERS, _GENDER_NULL) + "SELECT * FROM gender_null ORDER BY movie_id",
    "q_age4_avg": _with(_MOVIES, _ALL_USERS, _AGE4) + "SELECT * FROM age4",
    "q_age7_avg": _with(_MOVIES, _USERS, _AGE7) + "SELECT * FROM age7 ORDER BY movie_id",
    "q_occupation_avg": _with(_OCCUPATION) + "SELECT * FROM occupation_avg ORDER BY avg_rating DESC, occupation",
    "q_year_avg": _with(_YEAR) + "SELECT * FROM year_avg ORDER BY year",
    "q_double": "SELECT l_orderkey, l_linenumber, l_quantity, l_quantity * 2 AS doubled FROM lineitem",
    # Reviews
    "q_clean_words": _with(_REVIEWS, _WORDS) + f"SELECT id, word FROM words WHERE word NOT IN ({_STOP})",
    "q_word_count": _with(_REVIEWS, _WORDS) + "SELECT word, count(id) AS total_words FROM words GROUP BY word",
    "q_word_count_over": _with(_REVIEWS, _WORDS)
    + "SELECT word, count(id) AS total_words FROM words GROUP BY word HAVING count(id) > 500",
    "q_reviews_by_category": _with(_REVIEWS)
    + "SELECT category, count(id) AS total_reviews FROM reviews GROUP BY category",
    "q_reviews_by_aspect": _with(_REVIEWS)
    + "SELECT aspect, count(id) AS total_reviews FROM reviews GROUP BY aspect",
    "q_top_negative_aspect": _top_aspects("negative"),
    "q_top_positive_aspect": _top_aspects("positive"),
    "q_top_negative_aspect_limit1": _top_aspect("negative"),
    "q_top_positive_aspect_limit1": _top_aspect("positive"),
    "q_top5_positive_words": _with(_REVIEWS, _WORDS, _top_words("sentiment = 'positive'"))
    + "SELECT * FROM top_words",
    "q_top5_negative_words": _with(_REVIEWS, _WORDS, _top_words("sentiment = 'negative'"))
    + "SELECT * FROM top_words",
    "q_top5_words": _with(_REVIEWS, _WORDS, _top_words("true")) + "SELECT * FROM top_words",
    # Orders
    "q_schema_report": "\nUNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, "
        f"count({c}) < count(*) AS has_null FROM orders"
        for i, (c, t) in enumerate(_ORDER_COLUMNS.items(), 1)
    ),
    "q_totals": _with(_TOTALS) + "SELECT metric, total FROM totals",
    "q_orders_by_country": """
        SELECT n_name AS country, count(*) AS n_orders
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY n_name ORDER BY n_orders DESC, country""",
    "q_orders_by_month": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
               count(*) AS n_orders
        FROM orders GROUP BY 1, 2 ORDER BY 1, 2 DESC""",
    "q_review_scores": _with(_SCORES)
    + """SELECT score, count(*) AS n_reviews,
                (SELECT avg(score) FROM scores WHERE score BETWEEN 1 AND 5) AS avg_score
         FROM scores WHERE score BETWEEN 1 AND 5 GROUP BY score ORDER BY score""",
    "q_revenue_by_category": f"""
        SELECT p_type AS category,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(12, 2)) + CAST(l_tax AS DECIMAL(12, 2))) AS DOUBLE) AS revenue
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        WHERE year(o_orderdate) = {REVENUE_YEAR} GROUP BY p_type""",
    "q_best_selling_product": """
        SELECT l_partkey AS product_id, count(*) AS n_sold FROM lineitem GROUP BY l_partkey
        ORDER BY n_sold DESC, CAST(l_partkey AS VARCHAR) LIMIT 1""",
    "q_product_scores": _with(_SCORES)
    + """SELECT l_partkey AS product_id, avg(score) AS avg_score, count(*) AS n_scores
         FROM lineitem JOIN scores ON l_orderkey = order_id WHERE score BETWEEN 1 AND 5 GROUP BY l_partkey""",
    "q_delivery_delay": """
        SELECT count(days) AS n_items, avg(days) AS avg_delay_days,
               avg(CASE WHEN days > 0 THEN 1 ELSE 0 END) AS late_share
        FROM (SELECT date_diff('day', l_shipdate, o_orderdate) AS days
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "q_customer_segments": _with(_SEGMENTS) + "SELECT * FROM segments",
    "q_segment_sizes": _with(_SEGMENTS)
    + "SELECT segment, count(*) AS n_customers FROM segments GROUP BY segment",
    "q_segments_by_share": _with(_SEGMENTS_BY_SHARE) + "SELECT * FROM segments",
    "q_customer_tiles": """
        SELECT customer_id, CAST(value AS DOUBLE) AS value,
               ntile(10) OVER (ORDER BY value DESC, customer_id DESC) AS tile
        FROM (SELECT o_custkey AS customer_id, sum(CAST(o_totalprice AS DECIMAL(14, 2))) AS value
              FROM orders GROUP BY o_custkey)""",
    "q_seller_ranking": """
        SELECT seller_id, CAST(revenue AS DOUBLE) AS revenue, n_orders,
               rank() OVER (ORDER BY revenue DESC, n_orders DESC) AS seller_rank
        FROM (SELECT l_suppkey AS seller_id, count(DISTINCT l_orderkey) AS n_orders,
                     sum(CAST(l_extendedprice AS DECIMAL(12, 2)) + CAST(l_tax AS DECIMAL(12, 2))) AS revenue
              FROM lineitem GROUP BY l_suppkey)""",
    # Report lines
    "report_movie_pairs": _with(_MOVIES, _MOVIE_OUTER)
    + """SELECT title || chr(9) || 'Diem Trung Binh: ' || CAST(avg_rating AS VARCHAR)
             || ' (Tong so luot: ' || n_ratings || ')' AS line FROM movie_outer""",
    "report_champion_pair": _with(_MOVIES, _MOVIE_OUTER, _best("movie_outer", MIN_SUPPORT))
    + f"""SELECT '=> QUAN QUAN: ' || chr(9) || title || ' is the highest rated movie with an average rating of '
             || CAST(avg_rating AS VARCHAR) || ' among movies with at least {MIN_SUPPORT} ratings.' AS line FROM best""",
    "report_no_champion_pair": f"""
        SELECT '=> QUAN QUAN: ' || chr(9) || ' is the highest rated movie with an average rating of 0.0 '
             || 'among movies with at least {10**9} ratings.' AS line
        WHERE (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey)) < {10**9}""",
    "report_genre_pairs": _with(_MOVIES, _GENRES)
    + f"""SELECT genre || chr(9) || 'Avg: ' || {_half_up("avg_rating")} || ', Count: ' || n_ratings AS line
          FROM genre_avg""",
    "report_gender_pairs": _with(_MOVIES, _ALL_USERS, _GENDER_ZERO)
    + f"""SELECT title || chr(9) || 'Male: ' || {_half_up("avg_male")} || ', Female: ' || {_half_up("avg_female")}
              AS line FROM gender_zero""",
    "report_age4_pairs": _with(_MOVIES, _ALL_USERS, _AGE4)
    + f"""SELECT title || chr(9) || '0-18: ' || {_age4_text("0_18")} || '   18-35: ' || {_age4_text("18_35")}
              || '   35-50: ' || {_age4_text("35_50")} || '   50+: ' || {_age4_text("50_plus")} AS line FROM age4""",
    "report_movie_lines": _with(_MOVIES, _MOVIE_INNER)
    + """SELECT printf('MovieID: %d | Title: %s | AvgRating: %.2f | Count: %d', movie_id, title, avg_rating, n_ratings)
             AS line FROM movie_inner""",
    "report_winner_line": _with(_MOVIES, _MOVIE_INNER, _best("movie_inner", MIN_SUPPORT, ""))
    + """SELECT 'WINNER -> Title: ''' || title || printf(''' | Điểm: %.2f', avg_rating)
             || ' | Lượt đánh giá: ' || n_ratings AS line FROM best""",
    "report_no_winner_line": f"SELECT 'Không có phim nào đạt điều kiện >= {10**9} lượt đánh giá.' AS line",
    "report_country_table": _table(
        "SELECT n_name AS a, count(*) AS b FROM orders JOIN customer ON o_custkey = c_custkey "
        "JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
        ["Customer_Country", "count"],
    ),
    "report_month_table": _table(
        "SELECT year(o_orderdate) AS a, month(o_orderdate) AS b, count(*) AS c FROM orders GROUP BY 1, 2",
        ["Year", "Month", "count"],
    ),
    "report_genre_lines": _with(_MOVIES, _GENRES)
    + """SELECT format('Genre: {:<15} | AvgRating: {:.2f} | Total Ratings: {}', genre, avg_rating, n_ratings) AS line
         FROM genre_avg""",
    "report_gender_lines": _with(_MOVIES, _USERS, _GENDER_NULL)
    + """SELECT format('MovieID: {:<5} | {:<40} | Male Avg: {:<5} | Female Avg: {:<5}',
                       CAST(movie_id AS VARCHAR), left(title, 40),
                       coalesce(printf('%.2f', avg_male), 'N/A'), coalesce(printf('%.2f', avg_female), 'N/A')) AS line
         FROM gender_null ORDER BY movie_id""",
    "report_age7_lines": _with(_MOVIES, _USERS, _AGE7)
    + f"""SELECT format('ID: {{:<4}} | {{:<35}} | ', CAST(movie_id AS VARCHAR), left(title, 35))
              || {" || ' | ' || ".join(_age7_text(t, n) for t, n in zip(_SEVEN_LABELS, _SEVEN))} AS line
          FROM age7 ORDER BY movie_id""",
    "report_occupation_lines": _with(_OCCUPATION)
    + """SELECT format('Occupation: {:<20} | AvgRating: {:.2f} | Total Ratings: {}', occupation, avg_rating, n_ratings)
             AS line FROM occupation_avg ORDER BY avg_rating DESC, occupation""",
    "report_year_lines": _with(_YEAR)
    + """SELECT printf('Year: %d | AvgRating: %.2f | Total Ratings: %d', year, avg_rating, n_ratings) AS line
         FROM year_avg ORDER BY year""",
    "report_total_lines": _with(_TOTALS)
    + """SELECT CASE metric WHEN 'orders' THEN 'Tổng số đơn hàng' WHEN 'customers' THEN 'Tổng số khách hàng'
                            ELSE 'Tổng số người bán' END || ': ' || total AS line FROM totals""",
    # Operators on their own
    "scan_trimmed_drop_short": "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal >= 0",
    "scan_needed_fields_only": "SELECT c_custkey, c_name FROM customer",
    "scan_text_ids": "SELECT 'M' || c_custkey AS id, c_custkey + 3000000000 AS number, c_name FROM customer",
    "dim_parsed_then_one_per_key": """
        SELECT o_orderkey AS user_id, CAST(o_custkey % 80 AS INTEGER) AS age FROM orders""",
    "scan_short_row_null": """
        SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment FROM customer""",
    "scan_bounded_last_field": "SELECT doc_id, lang, text FROM documents",
    "scan_first_field": "SELECT c_name FROM customer",
    "scan_declared_no_quotes": "SELECT event_id, props, event_type, CAST(NULL AS INTEGER) AS bad_number FROM events",
    "lookup_salted": _with(_USERS)
    + """SELECT coalesce(u.gender, 'Unknown') AS gender, count(*) AS n, sum(l.l_quantity) AS total
         FROM lineitem l LEFT JOIN users u ON l.l_orderkey = u.user_id GROUP BY 1""",
    "lookup_hot_keys": _with(_USERS)
    + """SELECT coalesce(u.gender, 'Unknown') AS gender, count(*) AS n, sum(l.rating) AS total
         FROM (SELECT CASE WHEN l_orderkey % 9 < 3 THEN 1 WHEN l_orderkey % 9 > 3 THEN l_orderkey END AS user_id, l_quantity AS rating
               FROM lineitem) l LEFT JOIN users u USING (user_id) GROUP BY 1""",
    "hot_user": """
        WITH l AS (SELECT CASE WHEN l_orderkey % 9 < 3 THEN 1 WHEN l_orderkey % 9 > 3 THEN l_orderkey END AS user_id FROM lineitem)
        SELECT user_id FROM l WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) >= 0.2 * (SELECT count(*) FROM l)""",
    "q_movie_avg_from_partials": _with(_PARTS)
    + "SELECT movie_id, avg(rating) AS avg_rating, count(rating) AS n_ratings FROM parts GROUP BY movie_id",
    "scan_good_rows": """
        SELECT l_orderkey AS user_id, l_partkey AS movie_id, CAST(l_suppkey AS INTEGER) AS rating FROM lineitem WHERE l_linenumber < 5
        """,
    "scan_quarantined_rows": """
        SELECT CASE l_linenumber WHEN 5 THEN 'fields: 2' WHEN 6 THEN 'number: rating' ELSE 'empty: user_id' END AS problem,
               CASE l_linenumber WHEN 5 THEN concat(l_orderkey, ', ', l_partkey) WHEN 6 THEN concat(l_orderkey, ', ', l_partkey, ', n/a')
                                 ELSE concat(', ', l_partkey, ', ', l_suppkey) END AS value, l_returnflag AS file
        FROM lineitem WHERE l_linenumber >= 5""",
    "age_buckets": _with(_ALL_USERS)
    + f"""SELECT CASE WHEN u.age <= 18 THEN '0-18' WHEN u.age <= 35 THEN '18-35' WHEN u.age <= 50 THEN '35-50'
                     ELSE '50+' END AS four,
                CASE {" ".join(f"WHEN {c} THEN '{t}'" for t, c in zip(_SEVEN_LABELS, _SEVEN.values()))} END AS seven,
                count(*) AS n
          FROM all_users u GROUP BY 1, 2""",
    "union_all_parts": _with(_PARTS) + "SELECT movie_id, rating FROM parts",
    "distinct_pairs": "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem",
    "explode_genres": "SELECT p_partkey AS movie_id, unnest([p_type, p_brand]) AS genre FROM part",
    "two_decimals": """
        SELECT l_orderkey, l_linenumber, printf('%.2f', l_extendedprice * l_discount) AS binary_text,
               printf('%.2f', floor(l_quantity / 8 * 100 + 0.5) / 100) AS half_up_text FROM lineitem""",
    "key_value_lines": "SELECT lang || chr(9) || count(doc_id) AS line FROM documents GROUP BY lang",
    "semicolon_lines": _with(_REVIEWS, _WORDS) + "SELECT word || ';' || count(id) AS line FROM words GROUP BY word",
    "nested_bag_lines": _with(_REVIEWS, _WORDS, _top_words("true"))
    + """SELECT category || ';{' || string_agg('(' || category || ',' || word || ',' || cnt || ')', ',' ORDER BY "rank")
             || '}' AS line FROM top_words GROUP BY category""",
    "nested_bag_read_back": _with(_REVIEWS, _WORDS, _top_words("true"))
    + "SELECT category, CAST(NULL AS VARCHAR) AS reason, word, cnt AS n FROM top_words",
    "q_totals_from_sketches": _with(_TOTALS)
    + "SELECT metric, total, true AS within_bound FROM totals WHERE metric <> 'orders'",
    "best_movie_seen": _with(_MOVIES, _MOVIE_OUTER, _best("movie_outer", MIN_SUPPORT))
    + """SELECT title, avg_rating, n_ratings, (SELECT count(*) FROM movie_outer) AS n_movies,
                (SELECT count(*) FROM movie_outer WHERE title = 'Chua_co_ten') AS n_untitled FROM best""",
}
SQL["delivery_delay_of_staged"] = SQL["q_delivery_delay"]
