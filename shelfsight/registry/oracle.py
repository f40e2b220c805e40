"""SQL with the same results as the queries, written independently of them."""

from __future__ import annotations

# Common table expressions, by name. A query names the ones it needs.

_PRODUCTS_RAW = """
products_raw AS (
  SELECT p_partkey,
    'P' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS asin,
    p_name AS title, p_brand AS brand, p_type,
    CASE WHEN p_partkey % 41 <> 0
      THEN 'https://example.com/dp/P' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') END AS url,
    string_split(p_name, ' ')[2] AS search_keyword,
    CASE WHEN p_partkey % 97 = 0 THEN CAST(0 AS DOUBLE)
      ELSE (p_retailprice - 899) * p_size / 10 END AS initial_price,
    CASE WHEN p_partkey % 10 IN (3, 7) THEN NULL
      ELSE (p_retailprice - 899) * p_size / 10 * (1 - (p_size % 5) * CAST(0.1 AS DOUBLE)) END AS final_price,
    CASE WHEN p_partkey % 53 = 0 THEN NULL
      ELSE (p_partkey % 51) / CAST(10 AS DOUBLE) END AS rating,
    CASE WHEN p_partkey % 29 = 0 THEN NULL
      ELSE CAST((p_partkey * 37) % 7000 AS DOUBLE) END AS reviews_count,
    CASE p_partkey % 4 WHEN 0 THEN 'In Stock' WHEN 1 THEN 'in stock soon'
      WHEN 2 THEN 'Out of Stock' END AS availability
  FROM part)"""

_PRODUCTS = _PRODUCTS_RAW + """,
products_priced AS (
  SELECT *, initial_price - final_price AS discount_amount,
    coalesce(final_price, initial_price) AS best_price,
    CASE
      WHEN initial_price IS NULL OR final_price IS NULL THEN CAST(0 AS DOUBLE)
      WHEN initial_price = 0 AND final_price > 0 THEN CAST('-inf' AS DOUBLE)
      WHEN initial_price = 0 AND final_price < 0 THEN CAST('inf' AS DOUBLE)
      WHEN initial_price = 0 THEN CAST(0 AS DOUBLE)
      ELSE round_even((initial_price - final_price) / initial_price * 100, 1)
    END AS discount_percent
  FROM products_raw),
products AS (
  SELECT *,
    CASE WHEN best_price <= 0 THEN NULL WHEN best_price <= 25 THEN 'Budget (<$25)'
      WHEN best_price <= 50 THEN 'Mid ($25-50)' WHEN best_price <= 100 THEN 'Premium ($50-100)'
      WHEN best_price <= 250 THEN 'High-end ($100-250)' WHEN best_price > 250 THEN 'Luxury ($250+)'
      END AS price_tier,
    CASE WHEN rating <= 0 THEN NULL WHEN rating <= 3 THEN 'Low (<3)' WHEN rating <= 4 THEN 'Average (3-4)'
      WHEN rating <= 4.5 THEN 'Good (4-4.5)' WHEN rating <= 5 THEN 'Excellent (4.5-5)' END AS rating_category,
    CASE WHEN reviews_count <= 0 THEN NULL WHEN reviews_count <= 100 THEN 'New (<100)'
      WHEN reviews_count <= 500 THEN 'Growing (100-500)' WHEN reviews_count <= 1000 THEN 'Popular (500-1K)'
      WHEN reviews_count <= 5000 THEN 'Very Popular (1K-5K)' WHEN reviews_count > 5000 THEN 'Best Seller (5K+)'
      END AS popularity,
    CASE WHEN p_partkey % 11 <> 0 THEN p_type END AS main_category
  FROM products_priced)"""

_REVIEWS = """
reviews_raw AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    'P' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS asin,
    CASE WHEN l_linenumber <> 7 THEN CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) END AS rating,
    l_shipdate AS scraped_at,
    l_returnflag = 'N' AS verified_purchase,
    CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN 'not json' WHEN 5 THEN '[]'
      WHEN 4 THEN '[' || chr(39) || lower(l_returnflag) || chr(39) || ', ' || chr(39) || lower(l_linestatus) || chr(39) || ']'
      ELSE '["' || lower(l_returnflag) || '","' || lower(l_linestatus) || '"]' END AS themes,
    CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN 'not json' WHEN 5 THEN '[]'
      WHEN 4 THEN '[' || chr(39) || 'size ' || CAST(l_suppkey % 17 AS VARCHAR) || chr(39) || ']'
      ELSE '["flag ' || lower(l_returnflag) || '","size ' || CAST(l_suppkey % 17 AS VARCHAR) || '"]' END AS issues,
    CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN ''
      ELSE l_returnflag || l_linestatus || ' line ' || CAST(l_linenumber AS VARCHAR) END AS ai_summary
  FROM lineitem),
reviews AS (
  SELECT *,
    CASE WHEN rating IS NULL THEN 'Unknown' WHEN rating >= 4 THEN 'Positive' WHEN rating >= 3 THEN 'Neutral'
      ELSE 'Negative' END AS sentiment,
    CASE WHEN json_valid(replace(themes, chr(39), '"'))
      THEN from_json(replace(themes, chr(39), '"'), '["VARCHAR"]') ELSE CAST([] AS VARCHAR[]) END AS theme_list,
    CASE WHEN json_valid(replace(issues, chr(39), '"'))
      THEN from_json(replace(issues, chr(39), '"'), '["VARCHAR"]') ELSE CAST([] AS VARCHAR[]) END AS issue_list,
    CAST(floor((epoch_us(TIMESTAMP '1998-06-01 12:00:00') - epoch_us(scraped_at)) / 86400000000.0) AS BIGINT)
      AS review_age_days,
    row_number() OVER (ORDER BY scraped_at DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey,
      l_extendedprice) AS seq
  FROM reviews_raw)"""

_BATCHES = """
text_reviews AS (
  SELECT d.doc_id, d.text, d.source,
    CASE WHEN l.toxic = 1 THEN 1.0 WHEN l.quality = 0 THEN 2.0 WHEN l.quality = 1 THEN 5.0 END AS rating
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
batched AS (
  SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 10 AS batch_id,
    CAST((row_number() OVER (ORDER BY doc_id) - 1) % 10 AS INTEGER) AS pos
  FROM text_reviews)"""

_MATCHES = _BATCHES + """,
sizes AS (SELECT batch_id, count(*) AS size FROM batched GROUP BY batch_id),
answers AS (
  SELECT b.batch_id, b.doc_id, s.size,
    CASE b.doc_id % 7 WHEN 1 THEN 99 WHEN 2 THEN 1 ELSE b.pos + 1 END AS idx,
    row_number() OVER (PARTITION BY b.batch_id
      ORDER BY CASE WHEN b.batch_id % 2 = 1 THEN -b.pos ELSE b.pos END) - 1 AS p
  FROM batched b JOIN sizes s ON b.batch_id = s.batch_id
  WHERE b.doc_id % 7 <> 0 AND b.batch_id % 9 NOT IN (0, 2)),
aimed AS (
  SELECT *, CASE WHEN idx BETWEEN 1 AND size THEN idx - 1 WHEN p < size THEN p END AS target FROM answers),
winners AS (
  SELECT batch_id, target, arg_max(doc_id, p) AS doc_id FROM aimed
  WHERE target IS NOT NULL GROUP BY batch_id, target),
answered AS (SELECT DISTINCT batch_id FROM answers),
matched AS (
  SELECT b.doc_id, b.batch_id, b.pos,
    CASE
      WHEN a.batch_id IS NOT NULL THEN
        CASE WHEN w.doc_id IS NULL THEN 'Unknown' ELSE ['Positive', 'Neutral', 'Negative'][w.doc_id % 3 + 1] END
      WHEN b.rating IS NULL THEN 'Unknown' WHEN b.rating >= 4 THEN 'Positive'
      WHEN b.rating >= 3 THEN 'Neutral' ELSE 'Negative' END AS sentiment,
    CASE WHEN w.doc_id IS NULL THEN '' ELSE 'issue ' || CAST(w.doc_id % 5 AS VARCHAR) END AS issues,
    CASE WHEN w.doc_id IS NULL THEN '' ELSE 'theme ' || CAST(w.doc_id % 4 AS VARCHAR) END AS themes,
    CASE WHEN w.doc_id IS NULL THEN '' ELSE 'about ' || CAST(w.doc_id AS VARCHAR) END AS ai_summary,
    CASE WHEN a.batch_id IS NULL THEN 'rating' WHEN w.doc_id IS NULL THEN 'unmatched' ELSE 'response' END
      AS analysis_method
  FROM batched b
  LEFT JOIN answered a ON b.batch_id = a.batch_id
  LEFT JOIN winners w ON b.batch_id = w.batch_id AND b.pos = w.target)"""

_RID = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
_DAY = "'%Y-%m-%d %H:%M:%S'"


def _with(base: str, body: str) -> str:
    return f"WITH {base.strip()}\n{body.strip()}"


def _p(body: str) -> str:
    return _with(_PRODUCTS, body)


def _r(body: str) -> str:
    return _with(_REVIEWS, body)


def _pr(body: str) -> str:
    return _with(_PRODUCTS + ",\n" + _REVIEWS.strip(), body)


def _gate(source: str, *rows: tuple[str, str, str, str]) -> str:
    """One SELECT per expectation: name, observed, rule, threshold."""
    tests = {"min": "observed >= threshold", "max": "observed <= threshold", "report": "TRUE"}
    parts = [
        f"SELECT name, {tests[rule]} AS passed, round(observed, 4) AS observed, threshold FROM ("
        f"SELECT '{name}' AS name, CAST({observed} AS DOUBLE) AS observed,"
        f" CAST({threshold} AS DOUBLE) AS threshold FROM {source})"
        for name, observed, rule, threshold in rows
    ]
    return "\nUNION ALL\n".join(parts)


_NOT_EMPTY = ("not_empty", "count(*)", "min", "1")


def _has(name: str) -> tuple[str, str, str, str]:
    return (f"has_{name}", "CASE WHEN count(*) >= 0 THEN 1 END", "min", "1")


def _text_statistics(column: str) -> str:
    return f"""
SELECT '{column}' AS "column", (SELECT count({column}) FROM products) AS count,
  (SELECT count(DISTINCT {column}) FROM products) AS "unique", t.v AS top, t.n AS freq,
  CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min,
  CAST(NULL AS DOUBLE) AS p25, CAST(NULL AS DOUBLE) AS p50, CAST(NULL AS DOUBLE) AS p75,
  CAST(NULL AS DOUBLE) AS max
FROM (SELECT {column} AS v, count(*) AS n FROM products WHERE {column} IS NOT NULL
  GROUP BY {column} ORDER BY n DESC, v LIMIT 1) t"""


def _number_statistics(column: str, table: str, head: str = "") -> str:
    """Infinite values make the mean infinite and leave no standard deviation."""
    finite = f"CASE WHEN isinf({column}) THEN NULL ELSE {column} END"
    infinite = f"count(*) FILTER (WHERE isinf({column})) > 0"
    return f"""
SELECT '{column}' AS "column", count({column}) AS count, {head}
  CASE WHEN {infinite} THEN CAST('-inf' AS DOUBLE) ELSE round(avg({finite}), 4) END AS mean,
  CASE WHEN {infinite} THEN NULL ELSE round(stddev_samp({finite}), 4) END AS std,
  round(min({column}), 4) AS min, round(quantile_cont({column}, 0.25), 4) AS p25,
  round(quantile_cont({column}, 0.5), 4) AS p50, round(quantile_cont({column}, 0.75), 4) AS p75,
  round(max({column}), 4) AS max
FROM {table}"""


_NO_TEXT = 'CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq,'
_FEED_GOOD = "doc_id % 13 <> 0 AND doc_id % 17 <> 0 AND doc_id % 19 <> 0"


def all_sql() -> dict[str, str]:
    sql = {}

    # Products
    sql["numeric_coercion"] = _p(
        "SELECT p_partkey, initial_price, final_price, rating, reviews_count FROM products_raw")
    sql["enrich_products"] = _p("""
SELECT asin, search_keyword, initial_price, final_price, discount_amount, discount_percent, best_price,
  price_tier, rating, rating_category, reviews_count, popularity, main_category FROM products""")
    sql["column_order"] = _p("""
SELECT asin, title, 'title,brand,asin,url,initial_price,final_price,rating,reviews_count,availability,p_partkey'
  AS column_names FROM products""")
    sql["filter_available"] = _p("""
SELECT asin, availability, best_price FROM products WHERE availability ILIKE '%in stock%'""")
    sql["filter_min_rating"] = _p("SELECT asin, rating FROM products WHERE rating >= 3.5")
    sql["filter_keyword_tier"] = _p("""
SELECT asin, search_keyword, price_tier, rating FROM products
WHERE search_keyword = 'widget' AND price_tier = 'Budget (<$25)' AND rating >= 0""")
    sql["product_kpis"] = _p("""
SELECT *, printf('$%.2f', avg_price) AS avg_price_text, printf('%.1f / 5.0', avg_rating) AS avg_rating_text,
  printf('%.1f%%', avg_discount) AS avg_discount_text
FROM (SELECT count(*) AS products, round(avg(best_price), 4) AS avg_price, round(avg(rating), 4) AS avg_rating,
  CASE WHEN count(*) FILTER (WHERE isinf(discount_percent)) > 0 THEN CAST('-inf' AS DOUBLE)
    ELSE round(avg(CASE WHEN isinf(discount_percent) THEN NULL ELSE discount_percent END), 4) END AS avg_discount
  FROM products)""")
    sql["price_stats"] = _p("""
SELECT min(best_price) AS min_price, max(best_price) AS max_price, round(avg(best_price), 4) AS avg_price,
  round(avg(rating), 4) AS avg_rating FROM products""")
    sql["discounted_count"] = _p(
        "SELECT count(*) FILTER (WHERE discount_percent > 0) AS discounted FROM products")
    sql["count_by_keyword"] = _p("""
SELECT search_keyword, count(*) AS count FROM products WHERE search_keyword IS NOT NULL GROUP BY search_keyword""")
    sql["price_tier_counts"] = _p("""
SELECT price_tier, count(*) AS count FROM products WHERE price_tier IS NOT NULL GROUP BY price_tier""")
    sql["distinct_options"] = _p("""
SELECT DISTINCT 'search_keyword' AS option, search_keyword AS value FROM products WHERE search_keyword IS NOT NULL
UNION ALL SELECT DISTINCT 'price_tier', price_tier FROM products WHERE price_tier IS NOT NULL""")
    sql["price_comparison"] = _p("""
SELECT left(title, 30) || '...' AS short_title, best_price, asin FROM products WHERE best_price IS NOT NULL""")
    sql["rating_comparison"] = _p("""
SELECT left(title, 30) || '...' AS short_title, rating, asin FROM products WHERE rating IS NOT NULL""")
    sql["price_vs_rating"] = _p("""
SELECT best_price, rating, reviews_count, title FROM products
WHERE best_price IS NOT NULL AND rating IS NOT NULL""")
    sql["product_table"] = _p("""
SELECT title, brand, best_price, rating, reviews_count, price_tier, rating_category, popularity,
  discount_percent, search_keyword FROM products""")
    sql["product_preview"] = _p("""
SELECT left(title, 50) AS title, CASE WHEN final_price IS NULL OR final_price = 0 THEN initial_price
  ELSE final_price END AS price, rating FROM products ORDER BY p_partkey LIMIT 3""")
    top = "(SELECT * FROM products ORDER BY reviews_count DESC NULLS LAST, asin LIMIT 4)"
    sql["top_n_products"] = _p(f"SELECT asin, url, reviews_count FROM {top} WHERE url IS NOT NULL")
    sql["selection_preview"] = _p(
        f"SELECT left(title, 40) AS title, reviews_count FROM {top} WHERE url IS NOT NULL")
    sql["top3_by_rating"] = _p("""
SELECT asin, title, rating, reviews_count FROM products
ORDER BY rating DESC NULLS LAST, reviews_count DESC NULLS LAST, asin LIMIT 3""")
    sql["reviews_for_top_products"] = _pr(f"""
SELECT asin, 'https://example.com/dp/' || asin AS url, {_RID} FROM reviews_raw
WHERE 'https://example.com/dp/' || asin IN (SELECT url FROM {top})""")
    sql["discover_by_keyword"] = _p("""
SELECT asin, title, keyword FROM (
  SELECT asin, title, keyword, turn, min(turn) OVER (PARTITION BY asin) AS earliest FROM (
  SELECT asin, title, keyword, turn,
    row_number() OVER (PARTITION BY keyword ORDER BY reviews_count DESC NULLS LAST, asin) AS place
  FROM (
    SELECT *, 'ring' AS keyword, 1 AS turn FROM products WHERE contains(lower(title), 'ring')
    UNION ALL SELECT *, 'Red Widget', 2 FROM products
      WHERE contains(lower(title), 'red') AND contains(lower(title), 'widget')
    UNION ALL SELECT *, 'wid get', 3 FROM products
      WHERE contains(lower(title), 'wid') AND contains(lower(title), 'get')))
  WHERE place <= 10)
WHERE turn = earliest""")

    # Reviews
    sql["cap_per_group"] = _r(f"""
SELECT asin, {_RID} FROM (SELECT *, row_number() OVER (PARTITION BY asin ORDER BY seq) AS place FROM reviews)
WHERE place <= 25""")
    sql["rating_sentiment"] = _r(f"SELECT {_RID}, rating, sentiment FROM reviews")
    sql["filter_sentiment"] = _r(f"SELECT {_RID}, sentiment FROM reviews WHERE sentiment = 'Negative'")
    sql["sentiment_distribution"] = _r("""
SELECT sentiment, count(*) AS count, round(count(*) / (SELECT count(*) FROM reviews) * 100, 4) AS pct
FROM reviews GROUP BY sentiment""")
    sql["rating_distribution"] = _r("""
SELECT rating, count(*) AS count, (SELECT round(avg(rating), 4) FROM reviews) AS avg_rating
FROM reviews WHERE rating IS NOT NULL GROUP BY rating""")
    sql["review_kpis"] = _r("""
SELECT *, printf('%.1f / 5.0', avg_rating) AS avg_rating_text, printf('%.1f%%', negative_pct) AS negative_text,
  printf('%.1f%%', positive_pct) AS positive_text
FROM (SELECT count(*) AS reviews, round(avg(rating), 4) AS avg_rating,
  round(avg(CASE WHEN sentiment = 'Negative' THEN 1.0 ELSE 0 END) * 100, 4) AS negative_pct,
  round(avg(CASE WHEN sentiment = 'Positive' THEN 1.0 ELSE 0 END) * 100, 4) AS positive_pct FROM reviews)""")
    sql["parse_list"] = _r(f"""
SELECT {_RID}, coalesce(array_to_string(theme_list, '|'), '') AS themes,
  CASE WHEN len(issue_list) > 0 THEN ' | Issues: ' || array_to_string(issue_list, ', ') ELSE '' END AS issue_text
FROM reviews""")
    sql["top_issues"] = _r("""
SELECT item, count(*) AS count FROM (SELECT unnest(issue_list) AS item FROM reviews)
GROUP BY item ORDER BY count DESC, item LIMIT 10""")
    sql["top_themes"] = _r("""
SELECT item, count(*) AS count FROM (SELECT unnest(theme_list) AS item FROM reviews)
GROUP BY item ORDER BY count DESC, item LIMIT 15""")
    sql["frequent_themes"] = _r("""
SELECT item, count(*) AS count FROM (SELECT unnest(theme_list) AS item FROM reviews)
GROUP BY item ORDER BY count DESC, item LIMIT 4""")
    sql["frequent_words"] = r"""
SELECT item, count(*) AS count FROM (SELECT unnest(regexp_split_to_array(lower(text), '[ \n]+')) AS item FROM documents)
GROUP BY item ORDER BY count DESC, item LIMIT 20"""
    first = """(SELECT seq, unnest(issue_list) AS issue, generate_subscripts(issue_list, 1) AS pos FROM reviews)"""
    sql["first_issues"] = _r(f"""
SELECT CAST(row_number() OVER (ORDER BY seq, pos) AS INTEGER) AS place, issue FROM {first} ORDER BY seq, pos LIMIT 10""")
    sql["review_recency"] = _r(f"""
SELECT {_RID}, strftime(scraped_at, {_DAY}) AS review_date, review_age_days, review_age_days <= 30 AS is_recent
FROM reviews""")
    sql["parse_dates"] = _r(f"""
SELECT {_RID}, CASE WHEN l_linenumber <= 5 THEN strftime(scraped_at, {_DAY}) END AS review_date,
  CASE WHEN l_linenumber <= 5 THEN review_age_days END AS review_age_days,
  l_linenumber <= 5 AND review_age_days <= 30 AS is_recent FROM reviews""")
    sql["recent_counts"] = _r("""
SELECT count(*) FILTER (WHERE review_age_days <= 30) AS recent,
  count(*) FILTER (WHERE review_age_days <= 30 AND sentiment = 'Negative') AS recent_negative FROM reviews""")
    sql["recent_negative"] = _r(f"""
SELECT {_RID}, review_age_days FROM reviews WHERE review_age_days <= 30 AND sentiment = 'Negative'""")
    sql["verified_share"] = _r("""
SELECT count(*) FILTER (WHERE verified_purchase) AS verified,
  round(avg(CASE WHEN verified_purchase THEN 1.0 ELSE 0 END) * 100, 4) AS verified_pct FROM reviews""")
    sql["products_covered"] = _r("SELECT count(DISTINCT asin) AS products FROM reviews")
    sql["analysis_coverage"] = _r("""
SELECT count(*) AS reviews, count(*) FILTER (WHERE sentiment <> 'Unknown') AS analysed,
  round(avg(CASE WHEN sentiment <> 'Unknown' THEN 1.0 ELSE 0 END) * 100, 4) AS coverage_pct FROM reviews""")
    sql["stored_coverage"] = _r("""
SELECT count(*) AS reviews, count(*) FILTER (WHERE sentiment <> 'Unknown') AS with_sentiment FROM reviews""")
    sql["has_analysis"] = _r(f"SELECT {_RID}, sentiment FROM reviews WHERE sentiment <> 'Unknown'")
    sql["review_summary"] = _r(f"""
SELECT count(*) AS total_reviews, round(avg(rating), 4) AS avg_rating,
  round(avg(CASE WHEN sentiment = 'Negative' THEN 1.0 ELSE 0 END) * 100, 4) AS negative_pct,
  TRUE AS ai_powered, 'rating-rule' AS models_used,
  (SELECT string_agg(issue, '|' ORDER BY seq, pos) FROM (
    SELECT * FROM {first} ORDER BY seq, pos LIMIT 10)) AS top_issues
FROM reviews""")
    sql["negative_rate_7d"] = _pr("""
SELECT r.asin, p.title AS product_name,
  round(avg(CASE WHEN r.sentiment = 'Negative' THEN 1.0 ELSE 0 END), 4) AS negative_rate, count(*) AS reviews
FROM reviews r JOIN products_raw p ON r.asin = p.asin
WHERE r.scraped_at > TIMESTAMP '1998-06-01 12:00:00' - INTERVAL 7 DAY
GROUP BY r.asin, p.title
HAVING avg(CASE WHEN r.sentiment = 'Negative' THEN 1.0 ELSE 0 END) > 0.2""")
    sql["negative_rate_sql"] = _r("""
SELECT asin, round(avg(CASE WHEN sentiment = 'Negative' THEN 1.0 ELSE 0 END), 4) AS negative_rate FROM reviews
WHERE scraped_at > TIMESTAMP '1998-06-01 12:00:00' - INTERVAL 7 DAY
GROUP BY asin HAVING avg(CASE WHEN sentiment = 'Negative' THEN 1.0 ELSE 0 END) > 0.2""")
    sql["summaries_by_sentiment"] = _r(f"""
SELECT sentiment, group_size, printf('%.1f', rating) || '/5 -- ' || ai_summary ||
  CASE WHEN len(issue_list) > 0 THEN ' | Issues: ' || array_to_string(issue_list, ', ') ELSE '' END AS line, {_RID}
FROM (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY seq) AS place,
    count(*) OVER (PARTITION BY sentiment) AS group_size
  FROM reviews WHERE ai_summary <> '' AND sentiment IN ('Positive', 'Neutral', 'Negative'))
WHERE place <= 10""")
    sql["review_table"] = _r(f"""
SELECT rating, sentiment, ai_summary, issues, themes, verified_purchase, strftime(scraped_at, {_DAY}) AS date
FROM reviews ORDER BY seq LIMIT 100""")

    # Statistics and context
    texts = ("title", "brand", "price_tier", "search_keyword", "popularity")
    numbers = ("best_price", "rating", "reviews_count", "discount_percent")
    sql["describe_products"] = _p("\nUNION ALL\n".join(
        [_text_statistics(c) for c in texts] + [_number_statistics(c, "products", _NO_TEXT) for c in numbers]))
    sql["describe_reviews"] = _r("\nUNION ALL\n".join(
        _number_statistics(f"{c}", "(SELECT l_extendedprice, rating, CAST(l_suppkey AS DOUBLE) AS l_suppkey FROM reviews)")
        for c in ("l_extendedprice", "rating", "l_suppkey")))
    sql["context_products"] = _p("""
SELECT title, brand, best_price, rating, reviews_count, price_tier, discount_percent, search_keyword, popularity
FROM products ORDER BY p_partkey LIMIT 20""")
    sql["context_reviews"] = _r("""
SELECT rating, sentiment, ai_summary, issues FROM reviews WHERE ai_summary <> '' ORDER BY seq LIMIT 25""")

    # Gates
    sql["gate_raw_products"] = _p(_gate(
        "products_raw", _NOT_EMPTY, _has("title"), _has("url"),
        ("null_titles", "count(*) FILTER (WHERE title IS NULL)", "max", "0"),
        ("negative_prices", "count(*) FILTER (WHERE final_price < 0)", "max", "0"),
        ("duplicate_asins", "count(asin) - count(DISTINCT asin)", "max", "0")))
    sql["gate_raw_reviews"] = _with(_BATCHES, _gate(
        "text_reviews", _NOT_EMPTY, _has("text"),
        ("ratings_outside_1_5", "count(*) FILTER (WHERE rating NOT BETWEEN 1 AND 5)", "max", "0"),
        ("products_covered", "count(DISTINCT source)", "report", "NULL")))
    sql["gate_enriched_products"] = _p(_gate(
        "products", _NOT_EMPTY, _has("best_price"), _has("price_tier"),
        ("valid_prices", "count(best_price)", "min", "1"),
        ("prices_not_positive", "count(*) FILTER (WHERE best_price <= 0)", "max", "0"),
        ("ratings_outside_0_5", "count(*) FILTER (WHERE rating NOT BETWEEN 0 AND 5)", "max", "0"),
        ("negative_discounts", "count(*) FILTER (WHERE discount_percent < 0)", "max", "0")))
    sql["gate_analysed_reviews"] = _r(_gate(
        "reviews", _NOT_EMPTY, _has("sentiment"), _has("issues"), _has("themes"), _has("ai_summary"),
        ("invalid_sentiments",
         "count(*) FILTER (WHERE sentiment NOT IN ('Positive', 'Neutral', 'Negative', 'Unknown'))", "max", "0"),
        ("coverage_pct", "avg(CASE WHEN sentiment = 'Unknown' THEN 0.0 ELSE 1 END) * 100", "min", "50")))
    sql["gate_stored_products"] = _p(_gate("products", _NOT_EMPTY))
    sql["gate_stored_reviews"] = _r(_gate(
        "reviews", _NOT_EMPTY,
        ("with_sentiment", "count(*) FILTER (WHERE sentiment <> 'Unknown')", "report", "NULL")))

    # Batches
    sql["row_numbers"] = _r(f"SELECT {_RID}, seq - 1 AS row_index FROM reviews")
    sql["assign_batches"] = _with(_BATCHES, "SELECT doc_id, batch_id, pos FROM batched")
    sql["assemble_batches"] = _with(_BATCHES, """
SELECT batch_id, CAST(count(*) AS INTEGER) AS n_reviews, CAST(length(string_agg(item, '' ORDER BY pos)) AS INTEGER) AS n_chars,
  md5(string_agg(item, '' ORDER BY pos)) AS digest
FROM (SELECT batch_id, pos, chr(10) || '[Review ' || CAST(pos + 1 AS VARCHAR) || '] (Rating: ' ||
    coalesce(printf('%.1f', CAST(rating AS DOUBLE)), 'N/A') || '/5)' || chr(10) || left(text, 500) || chr(10) AS item
  FROM batched) GROUP BY batch_id""")
    sql["prompt_batches"] = sql["assemble_batches"]
    sql["match_responses"] = _with(_MATCHES, "SELECT * FROM matched")
    sql["method_counters"] = _with(
        _MATCHES, "SELECT analysis_method, count(*) AS count FROM matched GROUP BY analysis_method")
    sql["enrich_batches"] = _with(_BATCHES, """
SELECT doc_id, CAST(rating AS DOUBLE) AS rating, CASE WHEN rating IS NULL THEN 'Unknown' WHEN rating >= 4 THEN 'Positive'
  WHEN rating >= 3 THEN 'Neutral' ELSE 'Negative' END AS sentiment, 'response' AS analysis_method FROM batched""")
    contents = """,
contents AS (SELECT batch_id, string_agg(md5(text) || coalesce(CAST(rating AS VARCHAR), '-'), ',' ORDER BY pos) AS content
  FROM batched GROUP BY batch_id)"""
    sql["enrich_batches_repeated"] = _with(_BATCHES + contents, """
SELECT doc_id, CASE WHEN rating IS NULL THEN 'Unknown' WHEN rating >= 4 THEN 'Positive'
  WHEN rating >= 3 THEN 'Neutral' ELSE 'Negative' END AS sentiment, 'response' AS analysis_method,
  (SELECT count(DISTINCT content) FROM contents) AS calls FROM batched""")
    sql["enrich_batches_quota"] = _with(_BATCHES, """
SELECT CASE WHEN asked THEN 'response' ELSE 'rating' END AS analysis_method, count(*) AS batches, true AS any_review
FROM (SELECT DISTINCT batch_id, batch_id IN (SELECT DISTINCT batch_id FROM batched ORDER BY batch_id LIMIT 6) AS asked FROM batched)
GROUP BY asked""")

    # Storage
    sql["upsert_products"] = _p("""
SELECT asin, title, best_price,
  CASE WHEN p_partkey % 11 = 0 THEN '[]' ELSE '["' || p_type || '","' || search_keyword || '"]' END AS categories,
  CASE WHEN search_keyword = 'widget' THEN '2024-01-11 00:00:00' ELSE '2024-01-10 00:00:00' END AS scraped_at
FROM products
UNION ALL
SELECT NULL, title, best_price,
  CASE WHEN p_partkey % 11 = 0 THEN '[]' ELSE '["' || p_type || '","' || search_keyword || '"]' END,
  '2024-01-12 00:00:00' FROM products WHERE url IS NULL""")
    sql["upsert_reviews"] = _r(f"""
SELECT {_RID}, asin, sentiment, CASE WHEN sentiment = 'Negative' THEN TRUE END AS second
FROM reviews WHERE sentiment = 'Negative' OR asin NOT IN (SELECT asin FROM reviews WHERE sentiment = 'Negative')""")
    sql["replace_all"] = _p("SELECT p_partkey, title, rating FROM products WHERE rating IS NOT NULL")
    sql["csv_round_trip"] = """
SELECT doc_id, md5(text) AS digest, lang, source, n_chars, '["' || lang || '","' || source || '"]' AS tags
FROM documents"""
    sql["best_source"] = _r(
        "SELECT sentiment, count(*) AS count, 'Tables' AS source_label FROM reviews GROUP BY sentiment")
    sql["products_over_runs"] = _r("""
, seen AS (SELECT *, CASE WHEN l_linenumber <= 2 THEN 'early' WHEN l_linenumber <= 4 THEN 'middle' ELSE 'late' END AS run
  FROM reviews WHERE l_linenumber <= 4 OR rating >= 2)
SELECT sentiment AS which, count(DISTINCT asin) AS products FROM seen GROUP BY sentiment
UNION ALL SELECT 'all', count(DISTINCT asin) FROM seen
UNION ALL SELECT 'early or late', count(DISTINCT asin) FROM seen WHERE run <> 'middle'
UNION ALL SELECT 'early and late', count(*) FROM (SELECT asin FROM seen WHERE run <> 'middle' GROUP BY asin HAVING count(DISTINCT run) = 2)""")

    def one(report: str, rows: str, **numbers: str) -> str:
        return " UNION ALL ".join(
            f"SELECT '{report}' AS report, '{n}' AS item, round(CAST({x} AS DOUBLE), 4) AS value FROM {rows}"
            for n, x in numbers.items())

    sql["rollup_products"] = _p(f"""
, stored AS (
  SELECT * REPLACE (CASE WHEN search_keyword = 'widget' THEN best_price / 2 ELSE best_price END AS best_price)
  FROM products WHERE p_partkey % 97 <> 0)
{one("kpis", "stored", products="count(*)", avg_price="avg(best_price)", avg_rating="avg(rating)",
     avg_discount="avg(discount_percent)")}
UNION ALL {one("prices", "stored", min_price="min(best_price)", max_price="max(best_price)",
               avg_price="avg(best_price)", avg_rating="avg(rating)")}
UNION ALL {one("discounted", "stored", discounted="count(*) FILTER (WHERE discount_percent > 0)")}
UNION ALL SELECT 'keywords', search_keyword || ' count', count(*) FROM stored WHERE search_keyword IS NOT NULL GROUP BY search_keyword
UNION ALL SELECT 'tiers', price_tier || ' count', count(*) FROM stored WHERE price_tier IS NOT NULL GROUP BY price_tier""")

    def share(flag: str) -> str:
        return f"100.0 * count(*) FILTER (WHERE {flag}) / count(*)"

    sql["rollup_reviews"] = _r(f"""
, stored AS (
  SELECT * REPLACE (CASE WHEN l_partkey % 3 = 1 THEN 'Neutral' ELSE sentiment END AS sentiment),
    l_partkey % 3 = 2 OR review_age_days <= 30 AS is_recent FROM reviews)
{one("kpis", "stored", reviews="count(*)", avg_rating="avg(rating)", negative_pct=share("sentiment = 'Negative'"),
     positive_pct=share("sentiment = 'Positive'"))}
UNION ALL {one("recent", "stored", recent="count(*) FILTER (WHERE is_recent)",
               recent_negative="count(*) FILTER (WHERE is_recent AND sentiment = 'Negative')")}
UNION ALL {one("verified", "stored", verified="count(*) FILTER (WHERE verified_purchase)",
               verified_pct=share("verified_purchase"))}
UNION ALL {one("analysed", "stored", reviews="count(*)", analysed="count(*) FILTER (WHERE sentiment <> 'Unknown')",
               coverage_pct=share("sentiment <> 'Unknown'"))}
UNION ALL {one("stored", "stored", reviews="count(*)", with_sentiment="count(*) FILTER (WHERE sentiment <> 'Unknown')")}
UNION ALL SELECT 'sentiments', sentiment || ' count', count(*) FROM stored GROUP BY sentiment
UNION ALL SELECT 'sentiments', sentiment || ' pct', round(100.0 * count(*) / (SELECT count(*) FROM stored), 4) FROM stored GROUP BY sentiment
UNION ALL SELECT 'ratings', printf('%.1f', rating) || ' count', count(*) FROM stored WHERE rating IS NOT NULL GROUP BY rating
UNION ALL SELECT 'ratings', printf('%.1f', rating) || ' avg_rating', round((SELECT avg(rating) FROM stored), 4)
FROM stored WHERE rating IS NOT NULL GROUP BY rating""")
    sql["scan_table"] = _p("""
SELECT asin, rating, price_tier,
  CASE WHEN rating > 2.5 THEN '2024-01-11 00:00:00' ELSE '2024-01-10 00:00:00' END AS scraped_at FROM products""")
    sql["backup_after_failure"] = _p("""
SELECT price_tier, count(*) AS count, 'CSV Files' AS source_label, 'ConnectionError: no database' AS primary_error
FROM products WHERE price_tier IS NOT NULL GROUP BY price_tier""")
    sql["price_history"] = _p(f"""
SELECT asin, strftime(scraped_at, {_DAY}) AS scraped_at, round(best_price, 4) AS best_price,
  round(lag(best_price) OVER w, 4) AS previous_price,
  round(best_price - lag(best_price) OVER w, 4) AS price_change
FROM (SELECT asin, TIMESTAMP '2024-01-10' AS scraped_at, best_price FROM products
  UNION ALL SELECT asin, TIMESTAMP '2024-01-12', best_price * 0.5 FROM products WHERE rating > 1)
WINDOW w AS (PARTITION BY asin ORDER BY scraped_at)""")
    sql["price_intervals"] = _p(f"""
SELECT asin, strftime(scraped_at, {_DAY}) AS scraped_at, round(price, 4) AS best_price,
  round(lag(price) OVER w, 4) AS previous_price, round(price - lag(price) OVER w, 4) AS price_change
FROM (SELECT asin, TIMESTAMP '2024-01-10' + INTERVAL 1 DAY * run AS scraped_at,
  best_price * (1 + ((p_partkey + run) // 3) % 2) AS price FROM products, range(5) AS r(run) WHERE p_partkey % 7 <> run)
WINDOW w AS (PARTITION BY asin ORDER BY scraped_at)""")
    sql["price_latest"] = _r(f"""
SELECT asin, strftime(scraped_at, {_DAY}) AS scraped_at, l_extendedprice AS best_price, rating
FROM (SELECT *, row_number() OVER (PARTITION BY asin
  ORDER BY scraped_at DESC, l_extendedprice DESC, rating DESC NULLS LAST) AS place FROM reviews) WHERE place = 1""")
    sql["price_changes"] = _r(f"""
SELECT asin, strftime(scraped_at, {_DAY}) AS scraped_at, round(price, 4) AS best_price,
  round(lag(price) OVER w, 4) AS previous_price, round(price - lag(price) OVER w, 4) AS price_change
FROM (SELECT asin, scraped_at, avg(l_extendedprice) AS price FROM reviews GROUP BY asin, scraped_at)
WINDOW w AS (PARTITION BY asin ORDER BY scraped_at)""")
    sql["price_weekly"] = _r(f"""
SELECT asin, strftime(week, {_DAY}) AS week, observations, avg_price, avg_rating, negative_pct,
  CASE WHEN adjacent THEN before.observations END AS previous_observations,
  CASE WHEN adjacent THEN before.avg_price END AS previous_avg_price,
  CASE WHEN adjacent THEN before.avg_rating END AS previous_avg_rating,
  CASE WHEN adjacent THEN before.negative_pct END AS previous_negative_pct
FROM (SELECT *, before.week = week - INTERVAL 7 DAY AS adjacent FROM (SELECT *, lag({{
    'week': week, 'observations': observations, 'avg_price': avg_price, 'avg_rating': avg_rating,
    'negative_pct': negative_pct}}) OVER (PARTITION BY asin ORDER BY week) AS before
FROM (SELECT asin, date_trunc('week', scraped_at) AS week, count(*) AS observations,
  round(avg(l_extendedprice), 4) AS avg_price, round(avg(rating), 4) AS avg_rating,
  round(avg(CASE WHEN sentiment = 'Negative' THEN 1.0 ELSE 0 END) * 100, 4) AS negative_pct
  FROM reviews GROUP BY asin, date_trunc('week', scraped_at))))""")

    # Snapshots
    sql["snapshot_json"] = f"""
SELECT doc_id, source AS asin, md5(text) AS digest FROM documents WHERE {_FEED_GOOD}"""
    sql["snapshot_mixed"] = "SELECT p_partkey, p_name AS title, p_brand AS brand FROM part WHERE p_partkey % 17 <> 3"
    sql["snapshot_array"] = "SELECT p_partkey, p_name AS title, p_brand AS brand FROM part"
    sql["snapshot_large_array"] = "SELECT doc_id, md5(text) AS digest, lang, source FROM documents"
    sql["error_counts"] = f"""
SELECT count(*) AS records, count(*) FILTER (WHERE {_FEED_GOOD}) AS successful,
  count(*) FILTER (WHERE doc_id % 13 = 0) AS errors
FROM documents WHERE doc_id % 13 = 0 OR ({_FEED_GOOD})"""

    # Streams: windows of seven days are counted from 1970-01-01.
    sql["negative_rate_stream"] = f"""
SELECT strftime(TIMESTAMP '1970-01-01' + INTERVAL 1 DAY * (7 * week), {_DAY}) AS window_start, user_id,
  count(*) AS reviews, count(*) FILTER (WHERE event_type = 'error') AS negative,
  round(count(*) FILTER (WHERE event_type = 'error') / count(*), 4) AS negative_rate
FROM (SELECT *, CAST(floor(epoch(ts) / 604800) AS INTEGER) AS week FROM events) GROUP BY week, user_id"""
    sql["negative_rate_sliding"] = f"""
SELECT strftime(day - INTERVAL 1 DAY * back, {_DAY}) AS window_start, user_id,
  count(*) AS reviews, count(*) FILTER (WHERE event_type = 'error') AS negative,
  round(count(*) FILTER (WHERE event_type = 'error') / count(*), 4) AS negative_rate
FROM (SELECT user_id, event_type, date_trunc('day', ts::TIMESTAMP)::TIMESTAMP AS day, unnest(range(7)) AS back FROM events)
GROUP BY day - INTERVAL 1 DAY * back, user_id"""
    # A day is judged when the newest event is more than a day behind its end.
    sql["negative_crossings"] = """
WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS bad
  FROM events GROUP BY user_id, CAST(ts AS DATE)),
ended AS (SELECT CAST(max(ts) - INTERVAL 1 DAY AS DATE) - 1 AS last FROM events),
judged AS (SELECT user_id, CAST(unnest(generate_series(CAST(min(day) AS TIMESTAMP), CAST(any_value(last) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
  FROM daily, ended GROUP BY user_id),
rates AS (SELECT j.user_id, j.day, coalesce(sum(n), 0) AS reviews, coalesce(sum(bad), 0) AS negative
  FROM judged j LEFT JOIN daily d ON d.user_id = j.user_id AND d.day <= j.day AND d.day > j.day - 7 GROUP BY j.user_id, j.day),
flags AS (SELECT *, lag(reviews > 0 AND negative > 0.25 * reviews, 1, false) OVER (PARTITION BY user_id ORDER BY day) AS before FROM rates)
SELECT user_id, CAST(day AS VARCHAR) AS day, round(negative / reviews, 4) AS negative_rate, CAST(reviews AS BIGINT) AS reviews,
  CAST(negative AS BIGINT) AS negative
FROM flags WHERE reviews > 0 AND negative > 0.25 * reviews AND NOT before"""
    sql["csv_newest"] = _pr("""
SELECT asin, round(best_price, 4) AS best_price, negative FROM products LEFT JOIN (
  SELECT asin, count(*) AS negative FROM reviews WHERE sentiment = 'Negative' GROUP BY asin) USING (asin)""")
    sql["skip_empty"] = """
SELECT 'all' AS name, false AS skipped, count(*) AS stored FROM part UNION ALL SELECT 'none', true, 0"""
    sql["enrich_empty"] = _p("SELECT asin, price_tier, rating_category, main_category FROM products")
    sql["ingest_by_run"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, run FROM (
  SELECT *, 'run=' || CASE WHEN l_linenumber <= 2 THEN 1 ELSE 2 END AS run,
    max(CASE WHEN l_linenumber <= 2 THEN 1 ELSE 2 END) OVER (PARTITION BY l_partkey) AS latest
  FROM lineitem)
WHERE run = 'run=' || latest"""
    sql["incremental_ingest"] = "SELECT p_partkey, p_name, p_retailprice FROM part"

    # A whole run over all parts
    found = """
found AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY reviews_count DESC NULLS LAST, asin) AS place
    FROM (
      SELECT *, 'ring' AS keyword FROM products WHERE contains(lower(title), 'ring')
      UNION ALL SELECT *, 'widget' FROM products WHERE contains(lower(title), 'widget'))
    )
  WHERE place <= 10),
chosen AS (
  SELECT url FROM (SELECT * FROM found ORDER BY reviews_count DESC NULLS LAST, asin LIMIT 4) WHERE url IS NOT NULL)"""
    capped = f"""
capped AS (
  SELECT *, row_number() OVER (PARTITION BY asin ORDER BY {_RID}) AS place
  FROM reviews WHERE 'https://example.com/dp/' || asin IN (SELECT url FROM chosen))"""
    run = ",\n".join(part.strip() for part in (_PRODUCTS, _REVIEWS, found, capped))
    sql["daily_run_repeated"] = _with(run, """
SELECT 'products' AS stored, count(*) AS rows FROM found UNION ALL SELECT 'history', count(*) FROM found
UNION ALL SELECT 'products backup', count(*) FROM found
UNION ALL SELECT 'reviews', count(*) FROM capped WHERE place <= 25
UNION ALL SELECT 'reviews backup', count(*) FROM capped WHERE place <= 25""")
    options = """
matching AS (
  SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY reviews_count DESC NULLS LAST, asin) AS place
  FROM (SELECT *, 'ring' AS keyword, 1 AS turn FROM products WHERE contains(lower(title), 'ring')
    UNION ALL SELECT *, 'red', 2 FROM products WHERE contains(lower(title), 'red'))),
earliest AS (SELECT *, min(turn) OVER (PARTITION BY asin) AS first_turn FROM matching WHERE place <= 40),
found AS (
  SELECT *, (p_partkey * 7) % 1500 AS bought FROM earliest
  WHERE turn = first_turn AND contains(lower(availability), 'in stock')),
chosen AS (SELECT url FROM (SELECT * FROM found ORDER BY bought DESC NULLS LAST, asin LIMIT 4) WHERE url IS NOT NULL)"""
    sql["run_options"] = _with(",\n".join(part.strip() for part in (_PRODUCTS, _REVIEWS, options, capped)), f"""
SELECT c.asin, f.keyword AS search_keyword, f.bought AS bought_past_month, c.sentiment, {_RID}
FROM capped c JOIN found f ON c.asin = f.asin WHERE c.place <= 25""")
    sql["daily_run"] = _with(run, f"""
SELECT c.asin, f.title, f.keyword AS search_keyword, c.sentiment,
  CAST(floor((epoch_us(TIMESTAMP '2024-01-10') - epoch_us(c.scraped_at)) / 86400000000.0) AS BIGINT)
    AS review_age_days, {_RID}
FROM capped c JOIN found f ON c.asin = f.asin WHERE c.place <= 25""")
    return sql
