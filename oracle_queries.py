"""Independently written DuckDB SQL for the registered queries.

Each statement rebuilds the review and product records from the shared test
tables with SQL expressions of the same meaning as the Spark adapter, then
computes the operator.  Rounding everywhere: the value is cast to
DECIMAL(28,10), rounded HALF_UP, cast back to DOUBLE (same rule as the Spark
side).  DuckDB sorts NULL last by default, so orderings name NULL placement.
"""

from __future__ import annotations


def _r(x: str, n: int = 2) -> str:
    return f"CAST(round(CAST(({x}) AS DECIMAL(28,10)), {n}) AS DOUBLE)"


LEAF = "CASE WHEN coalesce(len(categories), 0) >= 1 THEN categories[len(categories)] ELSE 'Unknown' END"
HEAD = "CASE WHEN coalesce(len(categories), 0) >= 1 THEN categories[1] ELSE 'Unknown' END"
SECOND_TS = 'epoch_ms(("timestamp" // 1000) * 1000)'

BASE = f"""
nd AS (SELECT count(*) AS n FROM documents),
reviews AS (
  SELECT concat(CASE WHEN l.l_partkey % 43 = 0 THEN 'X' ELSE 'P' END, l.l_partkey) AS parent_asin,
         concat('P', l.l_partkey, '-', l.l_suppkey) AS asin,
         concat('U', o.o_custkey) AS user_id,
         CASE WHEN l.l_orderkey % 101 = 0 THEN NULL
              ELSE CAST(least(5, 1 + floor((l.l_quantity + l.l_partkey % 50) / 10)) AS DOUBLE) END AS rating,
         concat('Review ', l.l_linenumber) AS title,
         CASE WHEN l.l_orderkey % 97 = 0 THEN NULL ELSE d.text END AS text,
         epoch_ms(l.l_shipdate) + (l.l_orderkey % 86400) * 1000 AS "timestamp",
         l.l_returnflag <> 'R' AS verified_purchase,
         CAST(round(l.l_discount * 100) AS BIGINT) AS helpful_vote
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  LEFT JOIN documents d ON d.doc_id = l.l_orderkey % (SELECT n FROM nd)
),
products AS (
  SELECT concat('P', CASE WHEN p_partkey % 59 = 0 THEN p_partkey - 1 ELSE p_partkey END) AS parent_asin,
         p_type AS main_category,
         p_name AS title,
         CAST(10 + p_partkey % 41 AS DOUBLE) / 10 AS average_rating,
         CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST((p_partkey * 37) % 100000 AS INTEGER) END AS rating_number,
         [p_name] AS features,
         [concat(p_type, ' item')] AS description,
         CASE WHEN p_partkey % 17 = 0 THEN NULL
              WHEN p_partkey % 19 = 0 THEN concat('from $', p_size)
              ELSE concat('$', printf('%.2f', p_size * 2.5::DOUBLE)) END AS price,
         CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE p_brand END AS store,
         CASE WHEN p_partkey % 31 = 0 THEN NULL
              WHEN p_partkey % 37 = 0 THEN CAST([] AS VARCHAR[])
              WHEN p_partkey % 7 = 0 THEN ['Goods']
              ELSE ['Goods', p_type] END AS categories
  FROM part
),
sampled AS (SELECT * FROM products WHERE parent_asin IN (SELECT parent_asin FROM reviews)),
dim AS (SELECT parent_asin, title AS product_title, main_category, store, price FROM sampled),
enriched0 AS (
  SELECT r.parent_asin, r.asin, r.user_id, r.rating, r.title AS review_title, r.text, r."timestamp",
         r.verified_purchase, r.helpful_vote, d.product_title, d.main_category, d.store, d.price,
         CAST(epoch_ms(r."timestamp") AS DATE) AS review_date,
         TRY_CAST(regexp_replace(d.price, '[$,]', '', 'g') AS DOUBLE) AS price_numeric,
         CAST(length(r.text) AS INTEGER) AS review_length
  FROM reviews r LEFT JOIN dim d ON d.parent_asin = r.parent_asin
),
enriched AS (
  SELECT *,
         CAST(date_trunc('month', review_date) AS DATE) AS review_year_month,
         CASE WHEN price_numeric IS NULL THEN 'Unknown'
              WHEN price_numeric < 20 THEN 'Budget (<$20)'
              WHEN price_numeric < 50 THEN 'Mid ($20-50)'
              WHEN price_numeric < 100 THEN 'Premium ($50-100)'
              ELSE 'Luxury ($100+)' END AS price_tier,
         CASE WHEN rating >= 4 THEN 'Positive' WHEN rating <= 2 THEN 'Negative' ELSE 'Neutral' END AS sentiment,
         CASE WHEN review_length >= 200 THEN 1 ELSE 0 END AS is_detailed_review
  FROM enriched0
),
st0 AS (
  SELECT store, review_year_month AS year_month, count(*) AS review_count, avg(rating) AS avg_rating,
         count(*) FILTER (WHERE sentiment = 'Positive') AS positive_count,
         count(*) FILTER (WHERE sentiment = 'Negative') AS negative_count,
         count(*) FILTER (WHERE sentiment = 'Neutral') AS neutral_count
  FROM enriched GROUP BY store, review_year_month
),
st1 AS (
  SELECT *, {_r("avg_rating - lag(avg_rating) OVER (PARTITION BY store ORDER BY year_month)", 3)} AS rating_change
  FROM st0
),
sentiment_trends AS (
  SELECT store, year_month, review_count, {_r("avg_rating")} AS avg_rating,
         positive_count, negative_count, neutral_count,
         {_r("positive_count / review_count * 100")} AS positive_rate,
         {_r("negative_count / review_count * 100")} AS negative_rate,
         rating_change,
         CASE WHEN rating_change > 0.1::DOUBLE THEN 'Improving'
              WHEN rating_change < -0.1::DOUBLE THEN 'Declining'
              ELSE 'Stable' END AS trend_direction
  FROM st1
),
ca0 AS (
  SELECT parent_asin, product_title, store, main_category, price_tier,
         count(*) AS total_reviews,
         count(DISTINCT user_id) AS unique_reviewers,
         avg(rating) AS avg_rating,
         stddev_samp(rating) AS rating_stddev,
         count(*) FILTER (WHERE sentiment = 'Positive') AS positive_reviews,
         count(*) FILTER (WHERE sentiment = 'Negative') AS negative_reviews,
         count(*) FILTER (WHERE sentiment = 'Neutral') AS neutral_reviews,
         avg(review_length) AS avg_review_length,
         CAST(sum(is_detailed_review) AS BIGINT) AS detailed_reviews,
         count(*) FILTER (WHERE verified_purchase) AS verified_purchases,
         avg(helpful_vote) AS avg_helpful_votes,
         min(review_date) AS first_review_date,
         max(review_date) AS last_review_date
  FROM enriched GROUP BY parent_asin, product_title, store, main_category, price_tier
),
competitive_analysis AS (
  SELECT parent_asin, product_title, store, main_category, price_tier, total_reviews, unique_reviewers,
         {_r("avg_rating")} AS avg_rating, {_r("rating_stddev")} AS rating_stddev,
         positive_reviews, negative_reviews, neutral_reviews,
         {_r("positive_reviews / total_reviews * 100")} AS satisfaction_rate,
         {_r("negative_reviews / total_reviews * 100")} AS negative_rate,
         {_r("avg_review_length")} AS avg_review_length,
         detailed_reviews, verified_purchases,
         {_r("verified_purchases / total_reviews * 100")} AS verified_rate,
         {_r("avg_helpful_votes")} AS avg_helpful_votes,
         first_review_date, last_review_date,
         CAST(date_diff('day', first_review_date, last_review_date) AS INTEGER) AS review_span_days
  FROM ca0
),
success_prediction AS (
  SELECT parent_asin, product_title, store,
         {_r("satisfaction_rate * 0.4::DOUBLE + (100 - rating_stddev * 20) * 0.3::DOUBLE + verified_rate * 0.3::DOUBLE")} AS success_score,
         CASE WHEN satisfaction_rate >= 85 AND total_reviews >= 40 THEN 'Top Performer'
              WHEN satisfaction_rate >= 80 AND total_reviews >= 25 THEN 'Strong Performer'
              WHEN satisfaction_rate >= 75 THEN 'Average Performer'
              ELSE 'Underperformer' END AS success_category,
         satisfaction_rate, rating_stddev, verified_rate,
         {_r("total_reviews / (review_span_days + 1)")} AS review_velocity,
         {_r("avg_review_length / 100 * (avg_helpful_votes + 1)")} AS engagement_score,
         total_reviews, avg_rating
  FROM competitive_analysis
),
va0 AS (
  SELECT parent_asin, product_title, store, review_year_month AS year_month,
         count(*) AS monthly_reviews, avg(rating) AS monthly_avg_rating
  FROM enriched GROUP BY parent_asin, product_title, store, review_year_month
),
va1 AS (
  SELECT *, lag(monthly_reviews) OVER (
           PARTITION BY parent_asin ORDER BY year_month, product_title NULLS FIRST, store NULLS FIRST) AS prev
  FROM va0
),
va2 AS (SELECT *, {_r("(monthly_reviews - prev) / (prev + 1) * 100")} AS velocity_change_pct FROM va1),
velocity_analysis AS (
  SELECT parent_asin, product_title, store, year_month, monthly_reviews,
         {_r("monthly_avg_rating")} AS monthly_avg_rating,
         CAST(prev AS INTEGER) AS prev_month_reviews,
         CAST(monthly_reviews - prev AS INTEGER) AS velocity_change,
         velocity_change_pct,
         CASE WHEN velocity_change_pct > 50 THEN 'Surging'
              WHEN velocity_change_pct > 20 THEN 'Growing'
              WHEN velocity_change_pct > -20 THEN 'Stable'
              WHEN velocity_change_pct > -50 THEN 'Declining'
              ELSE 'Collapsing' END AS momentum
  FROM va2
),
theme_prep AS (
  SELECT parent_asin, product_title, store, sentiment, count(*) AS review_count, {_r("avg(rating)")} AS avg_rating
  FROM enriched GROUP BY parent_asin, product_title, store, sentiment
  HAVING count(*) >= 10
),
counts AS (
  SELECT parent_asin, count(*) AS actual_reviews FROM reviews
  WHERE parent_asin IS NOT NULL AND parent_asin <> '' GROUP BY parent_asin
),
targets AS (
  SELECT p.parent_asin, p.title, p.store, c.actual_reviews
  FROM products p JOIN counts c ON c.parent_asin = p.parent_asin
  WHERE c.actual_reviews >= 30
  ORDER BY c.actual_reviews DESC, p.parent_asin LIMIT 50
),
brand_performance AS (
  SELECT store, count(*) AS total_reviews, avg(rating) AS avg_rating,
         count(*) FILTER (WHERE rating >= 4) AS positive_reviews,
         count(*) FILTER (WHERE rating <= 2) AS negative_reviews,
         count(*) FILTER (WHERE rating >= 4) / count(*) * 100 AS satisfaction_rate
  FROM enriched GROUP BY store
)"""


#: 32 bits that say whether a review is sampled: of the MD5 of the seed and what names the review.
SAMPLE_HASH = """('0x' || md5('42|' || coalesce('=' || parent_asin, '') || '|' || coalesce('=' || user_id, '') || '|' || coalesce('=' || "timestamp"::VARCHAR, ''))[1:8])::BIGINT"""


def _samples(source: str, n: int = 3) -> str:
    """Up to n distinct texts per product, most helpful first, '|'-joined."""
    return f"""(
  SELECT parent_asin, string_agg(text, '|' ORDER BY rn) AS sample_reviews, count(*) AS sample_count
  FROM (
    SELECT *, row_number() OVER (PARTITION BY parent_asin ORDER BY helpful_vote DESC, text) AS rn
    FROM (SELECT DISTINCT parent_asin, helpful_vote, text FROM {source} WHERE text IS NOT NULL)
  ) WHERE rn <= {n}
  GROUP BY parent_asin
)"""


def _completeness(table: str, columns: list[str]) -> str:
    counts = ", ".join(f'count("{c}") AS c{i}' for i, c in enumerate(columns))
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {i} AS position, c{i} AS non_null_count, total FROM w" for i, c in enumerate(columns)
    )
    return f"""
, w AS (SELECT count(*) AS total, {counts} FROM {table})
SELECT column_name, position, non_null_count, total AS total_rows,
       {_r("non_null_count / total * 100")} AS completeness_pct,
       CASE WHEN non_null_count / total * 100 > 80 THEN 'OK' ELSE 'LOW' END AS status
FROM ({rows})"""


def _pct_disc(p: float) -> str:
    # smallest length whose cumulative share reaches p (SQL PERCENTILE_DISC)
    return f"(SELECT min(len) FROM lr WHERE rn >= ceil({p} * n))"


REVIEW_COLUMNS = ["parent_asin", "asin", "user_id", "rating", "title", "text", "timestamp", "verified_purchase", "helpful_vote"]
METADATA_FIELDS = [
    "parent_asin", "title", "main_category", "categories", "price", "average_rating", "rating_number",
    "features", "description", "store",
]

ASK = """
SELECT s.store,
       count(*) AS products,
       CAST(round(CAST(avg(s.success_score) AS DECIMAL(28,10)), 2) AS DOUBLE) AS avg_success_score,
       sum(coalesce(v.surging_months, 0)) AS surging_months
FROM agg_success_prediction s
LEFT JOIN (
    SELECT parent_asin, count(*) AS surging_months
    FROM agg_review_velocity
    WHERE momentum = 'Surging'
    GROUP BY parent_asin
) v ON v.parent_asin = s.parent_asin
GROUP BY s.store
"""

_FINAL: dict[str, str] = {
    "product_dim": "SELECT parent_asin, product_title, main_category, store, price FROM dim",
    "prepare": """SELECT parent_asin, asin, user_id, rating, review_title, "timestamp", verified_purchase, helpful_vote,
        product_title, main_category, store, price, review_date, review_year_month, price_numeric, price_tier,
        sentiment, review_length, is_detailed_review FROM enriched""",
    "distinct_products": "SELECT DISTINCT parent_asin FROM reviews",
    "unmatched_products": """SELECT DISTINCT r.parent_asin FROM reviews r
        WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.parent_asin = r.parent_asin)""",
    "match_rate": f"""SELECT s.sampled_products, m.matched_products,
        CAST(round(CAST(m.matched_products / s.sampled_products * 100 AS DECIMAL(28,10)), 1) AS DOUBLE) AS match_rate_pct,
        s.sampled_products - m.matched_products AS missing_products
        FROM (SELECT count(*) AS sampled_products FROM (SELECT DISTINCT parent_asin FROM reviews)) s,
             (SELECT count(*) AS matched_products FROM sampled) m""",
    "sentiment_trends": "SELECT * FROM sentiment_trends",
    "competitive_analysis": "SELECT * FROM competitive_analysis",
    "success_prediction": """SELECT parent_asin, product_title, store, success_score, success_category,
        satisfaction_rate, rating_stddev, verified_rate, review_velocity, engagement_score FROM success_prediction""",
    "velocity_analysis": "SELECT * FROM velocity_analysis",
    "random_sample": f"""SELECT parent_asin, user_id, rating, "timestamp" FROM reviews
        WHERE {SAMPLE_HASH} < 42949672""",
    "random_per_group": f"""SELECT parent_asin, user_id, "timestamp" FROM (
        SELECT *, row_number() OVER (PARTITION BY parent_asin ORDER BY {SAMPLE_HASH}, user_id NULLS FIRST, "timestamp" NULLS FIRST) AS rn
        FROM reviews) WHERE rn <= 2""",
    "trends_from_states": "SELECT * FROM sentiment_trends",
    "velocity_from_states": "SELECT * FROM velocity_analysis",
    "competitive_from_states": "SELECT * FROM competitive_analysis",
    "unique_reviewers": """SELECT parent_asin, product_title, store, main_category, price_tier, unique_reviewers
        FROM competitive_analysis WHERE unique_reviewers > 0""",
    "sketch_accuracy": """SELECT * FROM (
        SELECT 'reviews' AS metric, count(*) AS exact, true AS within FROM enriched
        UNION ALL SELECT 'products', count(DISTINCT parent_asin), true FROM enriched
        UNION ALL SELECT 'reviewers', count(DISTINCT user_id), true FROM enriched
        UNION ALL SELECT unnest(['p25_length', 'median_length', 'p75_length']), count(review_length), true FROM enriched)""",
    "theme_prep": "SELECT * FROM theme_prep",
    "record_counts": "SELECT (SELECT count(*) FROM reviews) AS review_rows, (SELECT count(*) FROM products) AS product_rows",
    "review_counts": "SELECT * FROM counts",
    "rating_distribution": f"""SELECT rating, count(*) AS review_count,
        {_r("count(*) / (SELECT count(*) FROM reviews) * 100")} AS pct FROM reviews GROUP BY rating""",
    "overall_rating": "SELECT avg(rating) AS avg_rating FROM reviews",
    "text_stats": f"""
        , lr AS (SELECT length(text) AS len, row_number() OVER (ORDER BY length(text)) AS rn,
                        count(*) OVER () AS n FROM reviews WHERE text IS NOT NULL)
        SELECT count(text) AS total_reviews,
               {_r("avg(length(text))")} AS avg_length,
               CAST(min(length(text)) AS INTEGER) AS min_length,
               CAST(max(length(text)) AS INTEGER) AS max_length,
               {_r("stddev_samp(length(text))")} AS std_length,
               CAST({_pct_disc(0.5)} AS BIGINT) AS median_length,
               CAST({_pct_disc(0.25)} AS BIGINT) AS p25_length,
               CAST({_pct_disc(0.75)} AS BIGINT) AS p75_length
        FROM reviews""",
    "product_stats": f"""SELECT parent_asin, count(*) AS review_count, {_r("avg(rating)")} AS avg_rating,
        {_r("stddev_samp(rating)")} AS rating_stddev FROM reviews GROUP BY parent_asin""",
    "product_summary": """SELECT count(DISTINCT parent_asin) AS unique_products,
        CAST(round(CAST(count(*) / count(DISTINCT parent_asin) AS DECIMAL(28,10)), 0) AS BIGINT) AS avg_reviews_per_product
        FROM reviews""",
    "completeness": _completeness("reviews", REVIEW_COLUMNS),
    "metadata_completeness": _completeness("products", METADATA_FIELDS),
    "text_category_distribution": """SELECT CASE WHEN length(text) < 50 THEN 'Very Short (<50)'
             WHEN length(text) < 200 THEN 'Short (50-200)'
             WHEN length(text) < 500 THEN 'Medium (200-500)'
             WHEN length(text) < 1000 THEN 'Long (500-1000)'
             ELSE 'Very Long (1000+)' END AS text_category, count(*) AS review_count
        FROM reviews GROUP BY 1""",
    "reviews_by_year": """SELECT CAST(year(CAST(epoch_ms("timestamp") AS DATE)) AS INTEGER) AS review_year,
        count(*) AS review_count FROM reviews GROUP BY 1""",
    "date_range": f"SELECT min({SECOND_TS}) AS earliest, max({SECOND_TS}) AS latest FROM reviews",
    "verified_distribution": f"""SELECT verified_purchase, count(*) AS review_count,
        {_r("count(*) / (SELECT count(*) FROM reviews) * 100")} AS pct FROM reviews GROUP BY 1""",
    "helpfulness_stats": f"""SELECT count(*) FILTER (WHERE helpful_vote > 0) AS reviews_with_votes,
        {_r("avg(helpful_vote)")} AS avg_helpful, max(helpful_vote) AS max_helpful FROM reviews""",
    "review_profile": f"""
        , n AS (SELECT count(*) AS n FROM reviews)
        , r AS (
            SELECT 'rating' AS report, CAST(rating AS VARCHAR) AS key, count(*) AS review_count FROM reviews GROUP BY rating
            UNION ALL SELECT 'text_category', CASE WHEN length(text) < 50 THEN 'Very Short (<50)'
                     WHEN length(text) < 200 THEN 'Short (50-200)'
                     WHEN length(text) < 500 THEN 'Medium (200-500)'
                     WHEN length(text) < 1000 THEN 'Long (500-1000)'
                     ELSE 'Very Long (1000+)' END, count(*) FROM reviews GROUP BY 2
            UNION ALL SELECT 'review_year', CAST(year(CAST(epoch_ms("timestamp") AS DATE)) AS VARCHAR), count(*) FROM reviews GROUP BY 2
            UNION ALL SELECT 'verified', CAST(verified_purchase AS VARCHAR), count(*) FROM reviews GROUP BY 2)
        SELECT report, key, review_count, {_r("review_count / (SELECT n FROM n) * 100")} AS pct, NULL::TIMESTAMP AS earliest, NULL::TIMESTAMP AS latest,
               NULL::BIGINT AS reviews_with_votes, NULL::DOUBLE AS avg_helpful, NULL::BIGINT AS max_helpful FROM r
        UNION ALL
        SELECT 'total', NULL, count(*), 100.0, min({SECOND_TS}), max({SECOND_TS}), count(*) FILTER (WHERE helpful_vote > 0),
               {_r("avg(helpful_vote)")}, max(helpful_vote) FROM reviews""",
    "category_distribution": "SELECT main_category, count(*) AS product_count FROM sampled GROUP BY 1",
    "store_distribution": "SELECT store, count(*) AS product_count FROM sampled GROUP BY 1",
    "high_density_summary": """SELECT count(*) AS products, CAST(sum(rating_number) AS BIGINT) AS total_ratings
        FROM products WHERE rating_number >= 10000""",
    "exclude_store": "SELECT parent_asin, store FROM products WHERE NOT coalesce(contains(lower(store), 'brand#2'), false)",
    "priced_products": "SELECT parent_asin, price FROM sampled WHERE price IS NOT NULL",
    "head_category_counts": f"""SELECT {HEAD} AS category, count(*) AS product_count
        FROM products WHERE rating_number >= 10000 GROUP BY 1""",
    "leaf_category_counts": f"""SELECT {LEAF} AS category, count(*) AS product_count
        FROM products WHERE rating_number >= 50000 GROUP BY 1""",
    "store_counts": """SELECT store, count(*) AS product_count FROM products
        WHERE rating_number >= 10000 AND store IS NOT NULL GROUP BY 1""",
    "metadata_stats": f"""SELECT count(rating_number) AS rated_products, {_r("avg(rating_number)", 1)} AS avg_rating_number,
        max(rating_number) AS max_rating_number FROM products""",
    "brand_performance": "SELECT * FROM brand_performance",
    "brand_comparison": f"""SELECT store, count(*) AS reviews, {_r("avg(rating)")} AS avg_rating,
        {_r("count(*) FILTER (WHERE sentiment = 'Positive') / count(*) * 100")} AS satisfaction_rate
        FROM enriched WHERE contains(main_category, 'ECON') GROUP BY store""",
    "success_distribution": "SELECT success_category, count(*) AS product_count FROM success_prediction GROUP BY 1",
    "exploration_summary": f"""SELECT count(*) AS total_rows, count(DISTINCT parent_asin) AS unique_products,
        avg(rating) AS avg_rating, min({SECOND_TS}) AS earliest, max({SECOND_TS}) AS latest FROM reviews""",
    "verified_comparison": f"""SELECT verified_purchase, count(*) AS review_count, {_r("avg(rating)")} AS avg_rating,
        {_r("avg(review_length)")} AS avg_review_length, {_r("avg(helpful_vote)")} AS avg_helpful_votes
        FROM enriched GROUP BY 1""",
    "seasonality": """SELECT CAST(month(year_month) AS INTEGER) AS review_month,
        CAST(sum(monthly_reviews) AS BIGINT) AS total_reviews, count(*) AS product_months,
        count(DISTINCT parent_asin) AS products FROM velocity_analysis GROUP BY 1""",
    "products_with_counts": """SELECT p.parent_asin, p.title, p.store, p.rating_number, c.actual_reviews
        FROM products p JOIN counts c ON c.parent_asin = p.parent_asin""",
    "top_products": "SELECT parent_asin, actual_reviews FROM counts ORDER BY actual_reviews DESC, parent_asin LIMIT 20",
    "label_top_products": """SELECT t.parent_asin, t.actual_reviews,
        coalesce(l.title, concat('ASIN: ', t.parent_asin)) AS label, l.store
        FROM (SELECT * FROM counts ORDER BY actual_reviews DESC, parent_asin LIMIT 20) t
        LEFT JOIN (SELECT parent_asin, min(title) AS title, min(store) AS store FROM products GROUP BY parent_asin) l
          ON l.parent_asin = t.parent_asin""",
    "target_products": "SELECT * FROM targets",
    "target_summary": """SELECT count(*) AS pool_products, CAST(sum(c.actual_reviews) AS BIGINT) AS pool_reviews,
        (SELECT count(*) FROM targets) AS picked_products,
        (SELECT CAST(sum(actual_reviews) AS BIGINT) FROM targets) AS picked_reviews
        FROM products p JOIN counts c ON c.parent_asin = p.parent_asin WHERE c.actual_reviews >= 30""",
    "extract_sample": "SELECT * FROM reviews WHERE parent_asin IN (SELECT parent_asin FROM targets)",
    "sample_scan_report": """SELECT count(*) AS scanned_reviews,
        count(*) FILTER (WHERE parent_asin IN (SELECT parent_asin FROM targets)) AS extracted_reviews FROM reviews""",
    "top_reviewed": """SELECT parent_asin, title, rating_number, average_rating, store FROM products
        WHERE rating_number IS NOT NULL ORDER BY rating_number DESC, parent_asin LIMIT 10""",
    "top_reviewed_excluding_store": """SELECT parent_asin, title, rating_number, average_rating, store FROM products
        WHERE rating_number >= 10000 AND NOT coalesce(contains(lower(store), 'brand#2'), false)
        ORDER BY rating_number DESC, parent_asin LIMIT 15""",
    "top_per_category": f"""
        , hd AS (SELECT *, {LEAF} AS category FROM products WHERE rating_number >= 50000)
        , tc AS (SELECT category, count(*) AS category_products FROM hd GROUP BY category
                 ORDER BY category_products DESC, category LIMIT 5)
        , rk AS (SELECT hd.*, tc.category_products,
                        row_number() OVER (PARTITION BY hd.category ORDER BY rating_number DESC NULLS LAST, parent_asin)
                          AS rank_in_category
                 FROM hd JOIN tc ON tc.category = hd.category)
        SELECT category, category_products, CAST(rank_in_category AS INTEGER) AS rank_in_category,
               parent_asin, title, rating_number, store
        FROM rk WHERE rank_in_category <= 5""",
    "last_turns": """SELECT conv_id, turn, role, text FROM (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role NULLS FIRST, text NULLS FIRST) AS rn
        FROM conversations)
        WHERE rn <= 3""",
    "sample_reviews": f"SELECT * FROM {_samples('enriched')}",
    "example_reviews": """SELECT parent_asin, product_title, review_title, text, rating, helpful_vote FROM enriched
        WHERE contains(product_title, 'ring') AND sentiment = 'Negative'
        ORDER BY helpful_vote DESC, parent_asin NULLS FIRST, review_title NULLS FIRST, text NULLS FIRST,
                 rating NULLS FIRST LIMIT 3""",
    "store_recent_trend": """SELECT year_month, review_count, avg_rating, positive_rate, rating_change, trend_direction
        FROM sentiment_trends WHERE store = 'Brand#2' ORDER BY year_month DESC LIMIT 12""",
    "top_negative_products": """SELECT parent_asin, product_title, store, review_count, avg_rating FROM theme_prep
        WHERE sentiment = 'Negative'
        ORDER BY review_count DESC, parent_asin, product_title NULLS FIRST, store NULLS FIRST LIMIT 10""",
    "top_satisfaction": """SELECT parent_asin, product_title, store, total_reviews, avg_rating, satisfaction_rate,
        negative_rate FROM competitive_analysis WHERE total_reviews >= 25
        ORDER BY satisfaction_rate DESC NULLS LAST, parent_asin, product_title NULLS FIRST, store NULLS FIRST,
                 main_category NULLS FIRST, price_tier NULLS FIRST LIMIT 10""",
    "top_success": """SELECT parent_asin, product_title, store, success_score, satisfaction_rate, review_velocity,
        success_category FROM success_prediction
        ORDER BY success_score DESC NULLS LAST, parent_asin, product_title NULLS FIRST, store NULLS FIRST LIMIT 5""",
    "bottom_success": """SELECT parent_asin, product_title, store, success_score, satisfaction_rate, success_category
        FROM success_prediction
        ORDER BY success_score ASC NULLS FIRST, parent_asin, product_title NULLS FIRST, store NULLS FIRST LIMIT 5""",
    "top_brands": """SELECT * FROM brand_performance ORDER BY total_reviews DESC, store NULLS FIRST LIMIT 15""",
    "top_categories": """SELECT main_category, count(*) AS product_count FROM sampled GROUP BY 1
        ORDER BY product_count DESC, main_category NULLS FIRST LIMIT 10""",
    "top_stores": """SELECT store, count(*) AS product_count FROM sampled GROUP BY 1
        ORDER BY product_count DESC, store NULLS FIRST LIMIT 15""",
    "surging": """SELECT parent_asin, product_title, store, year_month, monthly_reviews, velocity_change_pct
        FROM velocity_analysis WHERE momentum = 'Surging'
        ORDER BY velocity_change_pct DESC, parent_asin, year_month, product_title NULLS FIRST, store NULLS FIRST LIMIT 10""",
    "declining": """SELECT parent_asin, product_title, store, year_month, monthly_reviews, velocity_change_pct, momentum
        FROM velocity_analysis WHERE momentum IN ('Declining', 'Collapsing')
        ORDER BY velocity_change_pct ASC NULLS FIRST, parent_asin, year_month, product_title NULLS FIRST,
                 store NULLS FIRST LIMIT 10""",
    "declining_after_first_month": """SELECT parent_asin, product_title, store, year_month, monthly_reviews,
        velocity_change_pct, momentum
        FROM velocity_analysis WHERE momentum IN ('Declining', 'Collapsing') AND velocity_change_pct IS NOT NULL
        ORDER BY velocity_change_pct ASC NULLS FIRST, parent_asin, year_month, product_title NULLS FIRST,
                 store NULLS FIRST LIMIT 10""",
    "latest_trends": """SELECT store, year_month, review_count, avg_rating, trend_direction FROM sentiment_trends
        ORDER BY year_month DESC, store NULLS FIRST LIMIT 10""",
    "latest_momentum": """SELECT parent_asin, product_title, year_month, monthly_reviews, momentum
        FROM velocity_analysis WHERE momentum IN ('Surging', 'Declining')
        ORDER BY year_month DESC, parent_asin, product_title NULLS FIRST, store NULLS FIRST LIMIT 10""",
    "null_checks": """SELECT 'sentiment_trends' AS table_name, count(*) AS total_rows,
               count(*) FILTER (WHERE year_month IS NULL) AS null_dates,
               count(*) FILTER (WHERE avg_rating IS NULL) AS null_ratings FROM sentiment_trends
        UNION ALL
        SELECT 'competitive_analysis', count(*), count(*) FILTER (WHERE first_review_date IS NULL),
               count(*) FILTER (WHERE avg_rating IS NULL) FROM competitive_analysis""",
    "range_checks": f"""SELECT 'avg_rating' AS metric, min(avg_rating) AS min_value, max(avg_rating) AS max_value,
               {_r("avg(avg_rating)", 4)} AS avg_value FROM sentiment_trends
        UNION ALL
        SELECT 'positive_rate', min(positive_rate), max(positive_rate), {_r("avg(positive_rate)", 4)}
        FROM sentiment_trends""",
    "feature_summary": """SELECT 'Sentiment Trends' AS feature, count(*) AS row_count, count(DISTINCT store) AS unique_stores,
               min(year_month) AS earliest_date, max(year_month) AS latest_date FROM sentiment_trends
        UNION ALL SELECT 'Competitive Analysis', count(*), count(DISTINCT store), min(first_review_date),
               max(last_review_date) FROM competitive_analysis
        UNION ALL SELECT 'Success Prediction', count(*), count(DISTINCT store), CAST(NULL AS DATE), CAST(NULL AS DATE)
               FROM success_prediction
        UNION ALL SELECT 'Review Velocity', count(*), count(DISTINCT store), min(year_month), max(year_month)
               FROM velocity_analysis""",
    "duplicate_products": """SELECT parent_asin, count(*) AS metadata_rows FROM products
        GROUP BY parent_asin HAVING count(*) > 1""",
    "ask_sql": f"""
        , agg_success_prediction AS (SELECT * FROM success_prediction)
        , agg_review_velocity AS (SELECT * FROM velocity_analysis)
        SELECT store, products, avg_success_score, CAST(surging_months AS BIGINT) AS surging_months FROM ({ASK})""",
    "top_by_satisfaction": """SELECT parent_asin, product_title, store, total_reviews, avg_rating, satisfaction_rate,
        negative_rate FROM competitive_analysis
        ORDER BY satisfaction_rate DESC NULLS LAST, parent_asin, product_title NULLS FIRST, store NULLS FIRST,
                 main_category NULLS FIRST, price_tier NULLS FIRST LIMIT 5""",
    "feedback_for_top_rated": f"""
        , top AS (SELECT parent_asin, product_title, store, avg_rating, total_reviews FROM competitive_analysis
                  ORDER BY avg_rating DESC NULLS LAST, total_reviews DESC, parent_asin, product_title NULLS FIRST,
                           store NULLS FIRST, main_category NULLS FIRST, price_tier NULLS FIRST LIMIT 5)
        , top_reviews AS (SELECT * FROM enriched WHERE parent_asin IN (SELECT parent_asin FROM top))
        SELECT top.*, s.sample_reviews, s.sample_count
        FROM top LEFT JOIN {_samples('top_reviews')} s ON s.parent_asin = top.parent_asin""",
    "surging_products": """SELECT parent_asin, product_title, store, count(*) AS surging_months,
        max(velocity_change_pct) AS peak_change_pct, max(year_month) AS latest_surge_month
        FROM velocity_analysis WHERE momentum = 'Surging' GROUP BY parent_asin, product_title, store""",
    "compare_stores": f"""SELECT store, count(DISTINCT parent_asin) AS products, count(*) AS total_reviews,
        {_r("avg(rating)")} AS avg_rating,
        {_r("count(*) FILTER (WHERE sentiment = 'Positive') / count(*) * 100")} AS satisfaction_rate
        FROM enriched GROUP BY store""",
    "volume_up_sentiment_down": """SELECT store, year_month, review_count, prev_review_count, avg_rating, rating_change
        FROM (SELECT *, lag(review_count) OVER (PARTITION BY store ORDER BY year_month) AS prev_review_count
              FROM sentiment_trends)
        WHERE trend_direction = 'Declining' AND review_count > prev_review_count AND review_count >= 1""",
    "compare_categories": f"""SELECT main_category, count(DISTINCT parent_asin) AS products, count(*) AS total_reviews,
        {_r("avg(rating)")} AS avg_rating,
        {_r("count(*) FILTER (WHERE sentiment = 'Positive') / count(*) * 100")} AS satisfaction_rate,
        {_r("count(*) FILTER (WHERE sentiment = 'Negative') / count(*) * 100")} AS negative_rate
        FROM enriched GROUP BY main_category""",
    "peek": """SELECT parent_asin, title, description, categories, rating_number FROM (
        SELECT CASE WHEN length(parent_asin) > 12 THEN parent_asin[1:12] || '...' ELSE parent_asin END AS parent_asin,
               CASE WHEN length(title) > 12 THEN title[1:12] || '...' ELSE title END AS title,
               concat(coalesce(len(description), 0), ' items') AS description,
               concat(coalesce(len(categories), 0), ' items') AS categories, rating_number
        FROM (SELECT * FROM products ORDER BY products.parent_asin NULLS FIRST, products.title NULLS FIRST LIMIT 25))""",
    "display_rows": f"""SELECT parent_asin, CAST(review_count AS VARCHAR) AS review_count,
        coalesce(printf('%.2f', avg_rating), 'NULL') AS avg_rating, coalesce(printf('%.2f', rating_stddev), 'NULL') AS rating_stddev
        FROM (SELECT parent_asin, count(*) AS review_count, {_r("avg(rating)")} AS avg_rating,
                     {_r("stddev_samp(rating)")} AS rating_stddev FROM reviews GROUP BY parent_asin)""",
    "concat_parts": "SELECT * FROM customer UNION ALL BY NAME SELECT * FROM supplier",
    "cast_faults": """SELECT column_name, count(*) AS total_rows, count(*) FILTER (WHERE cell IS NULL) AS blank,
                             count(*) FILTER (WHERE cell IS NOT NULL AND NOT good) AS faulty
        FROM (SELECT 'parent_asin' AS column_name, parent_asin AS cell, TRUE AS good FROM products
              UNION ALL SELECT 'price', price, TRY_CAST(price AS DOUBLE) IS NOT NULL FROM products
              UNION ALL SELECT 'rating_number', CAST(rating_number AS VARCHAR), TRUE FROM products
              UNION ALL SELECT 'average_rating', store, TRY_CAST(store AS DOUBLE) IS NOT NULL FROM products)
        GROUP BY column_name""",
    "promote_staged": """SELECT parent_asin, TRY_CAST(price AS DOUBLE) AS price, rating_number, average_rating FROM products""",
    "feedback_for_product": f"""
        , m AS (SELECT * FROM enriched WHERE contains(product_title, 'ring'))
        , stats AS (SELECT parent_asin, product_title, store, count(*) AS total_reviews,
                           {_r("avg(rating)")} AS avg_rating FROM m GROUP BY parent_asin, product_title, store)
        SELECT stats.*, s.sample_reviews, s.sample_count
        FROM stats LEFT JOIN {_samples('m')} s ON s.parent_asin = stats.parent_asin""",
}


def _compose(final: str) -> str:
    # a final part that starts with ',' adds CTEs of its own before its SELECT
    return "WITH" + BASE + "\n" + final.strip()


ORACLE_SQL: dict[str, str] = {name: _compose(sql) for name, sql in _FINAL.items()}
