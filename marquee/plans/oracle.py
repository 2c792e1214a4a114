"""Independent DuckDB SQL for every registered query.

The SQL is written from the operator semantics, not generated from the
Spark plans: windows with QUALIFY where Spark uses aggregates, LEFT JOIN +
IS NULL where Spark uses anti joins, and so on.  Shared building blocks are
named CTEs; ``sql(final, *ctes)`` prepends them in dependency order.
"""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = (deps, body)


def sql(final: str, *names: str) -> str:
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for d in CTES[n][0]:
            visit(d)
        ordered.append(n)

    for n in names:
        visit(n)
    if not ordered:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n" + final


# --- revenue stand-in and staging -------------------------------------------------
cte("raw_rev", r"""
  SELECT CAST(l.l_orderkey * 10 + l.l_linenumber AS VARCHAR) AS id,
         CAST(l.l_shipdate AS DATE) AS revenue_date,
         ' ' || p.p_name || '  ' || p.p_brand AS title,
         CAST(round(l.l_extendedprice) AS DECIMAL(12,0)) AS revenue,
         CAST(l.l_quantity AS DECIMAL(6,0)) AS theaters,
         NULLIF(s.s_name, 'Supplier#000000001') AS distributor,
         l.l_shipdate AS _loaded_at
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey""")

cte("rev_latest", r"""
  SELECT * FROM (
    SELECT id, revenue_date, regexp_replace(trim(title), '\s+', ' ', 'g') AS title,
           revenue, theaters, distributor, _loaded_at
    FROM raw_rev) t
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY _loaded_at DESC, revenue_date DESC,
                             revenue DESC, theaters DESC, title DESC,
                             distributor DESC NULLS LAST) = 1""", ("raw_rev",))

cte("stg", r"""
  SELECT id, revenue_date, title,
         CAST(min(year(revenue_date)) OVER (PARTITION BY title) AS INTEGER) AS release_year,
         revenue, theaters, distributor
  FROM rev_latest""", ("rev_latest",))

# --- documents ---------------------------------------------------------------------
cte("films", r"""SELECT title, min(release_year) AS release_year FROM stg GROUP BY title""", ("stg",))

cte("first_part", r"""
  SELECT * FROM (
    SELECT regexp_replace(trim(p_name || ' ' || p_brand), '\s+', ' ', 'g') AS title,
           p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
    FROM part) t
  QUALIFY row_number() OVER (PARTITION BY title ORDER BY p_partkey) = 1""")

cte("docs_flat", r"""
  SELECT 'tt' || lpad(CAST(p.p_partkey AS VARCHAR), 7, '0') AS imdb_id,
         f.title AS lookup_title,
         f.release_year AS lookup_year,
         CASE WHEN p.p_size < 5 THEN NULL ELSE upper(p.p_name) END AS title,
         CASE WHEN p.p_size < 5 THEN NULL ELSE 'PG-13' END AS rated,
         CASE WHEN p.p_size < 5 THEN NULL ELSE '01 Jan ' || CAST(f.release_year AS VARCHAR) END AS released_raw,
         CASE WHEN p.p_size < 5 THEN NULL ELSE CAST(p.p_size AS BIGINT) END AS runtime_min,
         CASE WHEN p.p_size < 5 THEN NULL
              ELSE upper(left(p.p_type, 1)) || lower(substr(p.p_type, 2)) END AS genres,
         CASE WHEN p.p_size < 5 THEN NULL ELSE p.p_brand END AS director,
         CASE WHEN p.p_size < 5 THEN NULL ELSE p.p_name END AS writer,
         CASE WHEN p.p_size < 5 THEN NULL ELSE p.p_brand || ' ensemble' END AS actors,
         CASE WHEN p.p_size < 5 THEN NULL ELSE 'A story about a ' || p.p_name END AS plot,
         CASE WHEN p.p_size < 5 THEN NULL ELSE 'English' END AS languages,
         CASE WHEN p.p_size < 5 THEN NULL ELSE 'USA' END AS country,
         CAST(NULL AS VARCHAR) AS awards,
         CASE WHEN p.p_size < 5 THEN NULL ELSE 'poster_' || CAST(p.p_partkey AS VARCHAR) || '.jpg' END AS poster_url,
         CASE WHEN p.p_size < 5 THEN NULL ELSE CAST(p.p_size * 2 AS DOUBLE) / 10 END AS imdb_rating,
         CASE WHEN p.p_size < 5 THEN NULL ELSE CAST(p.p_size * 2 AS BIGINT) END AS metascore,
         CASE WHEN p.p_size < 5 THEN NULL ELSE CAST(p.p_partkey * 37 + 1000 AS BIGINT) END AS imdb_votes,
         CASE WHEN p.p_size < 5 THEN NULL ELSE CAST(round(p.p_retailprice * 1000) AS BIGINT) END AS box_office_omdb,
         CASE WHEN p.p_size < 5 OR p.p_type = 'MEDIUM' THEN NULL
              ELSE CAST(p.p_size * 2 AS BIGINT) END AS rotten_tomatoes_score,
         TIMESTAMP '2024-01-01 06:00:00' + (p.p_size - 1) * INTERVAL 1 DAY AS _fetched_at
  FROM films f JOIN first_part p ON f.title = p.title
  WHERE p.p_type <> 'PROMO'""", ("films", "first_part"))

# --- marts ------------------------------------------------------------------------
# The marts from the staged rows by windows: a film's or distributor's first row
# carries its totals, and no mart is read to make another.
cte("film_first", r"""
  SELECT * FROM (
    SELECT title, release_year,
           row_number() OVER film AS k,
           min(revenue_date) OVER (PARTITION BY title, release_year) AS first_revenue_date,
           max(revenue_date) OVER (PARTITION BY title, release_year) AS last_revenue_date,
           sum(revenue) OVER (PARTITION BY title, release_year) AS lifetime_revenue
    FROM stg WINDOW film AS (PARTITION BY title, release_year ORDER BY id)) WHERE k = 1""", ("stg",))

# A document and its film stand next to each other in one list; the film's totals are taken over.
cte("dim_movie", r"""
  SELECT * EXCLUDE (is_doc, n, name, lookup_year, _fetched_at), lookup_year AS release_year, _fetched_at AS omdb_fetched_at,
         CASE WHEN name IS NULL THEN lookup_title ELSE name END AS title
  FROM (
    SELECT d.* EXCLUDE (first_revenue_date, last_revenue_date, lifetime_revenue),
           max(first_revenue_date) OVER film AS first_revenue_date, max(last_revenue_date) OVER film AS last_revenue_date,
           max(lifetime_revenue) OVER film AS lifetime_revenue, count(*) FILTER (NOT is_doc) OVER film AS n
    FROM (
      SELECT true AS is_doc, * RENAME (title AS name), NULL::DATE AS first_revenue_date, NULL::DATE AS last_revenue_date,
             NULL::DECIMAL(38,0) AS lifetime_revenue FROM docs_flat
      UNION ALL BY NAME
      SELECT false AS is_doc, title AS lookup_title, release_year AS lookup_year, first_revenue_date, last_revenue_date,
             lifetime_revenue FROM film_first) d
    WINDOW film AS (PARTITION BY lookup_title, lookup_year))
  WHERE is_doc AND n > 0""",
    ("film_first", "docs_flat"))

cte("dim_distributor", r"""
  SELECT md5(name) AS distributor_key, name AS distributor_name,
         count(*) FILTER (WHERE k = 1) AS films_distributed_n, sum(revenue) AS lifetime_revenue
  FROM (SELECT distributor AS name, revenue,
               row_number() OVER (PARTITION BY distributor, title ORDER BY id) AS k FROM stg)
  WHERE name IS NOT NULL GROUP BY ALL""", ("stg",))

cte("fact", r"""
  SELECT id AS source_row_id,
         (SELECT max(imdb_id) FROM docs_flat
          WHERE lookup_title = stg.title AND lookup_year = stg.release_year) AS movie_key,
         CAST(year(revenue_date) * 10000 + month(revenue_date) * 100 + day(revenue_date) AS INTEGER) AS date_key,
         md5(distributor) AS distributor_key, revenue, theaters, revenue_date
  FROM stg WHERE distributor IS NOT NULL AND EXISTS (
    SELECT 1 FROM docs_flat WHERE lookup_title = stg.title AND lookup_year = stg.release_year)""",
    ("stg", "docs_flat"))

STG_OUT = """SELECT id, revenue_date, title, release_year, CAST(revenue AS BIGINT) AS revenue,
       CAST(theaters AS BIGINT) AS theaters, distributor FROM stg"""

DIM_MOVIE_OUT = """SELECT imdb_id, title, lookup_title, release_year, runtime_min, genres, director,
       writer, actors, plot, languages, country, rated, awards, poster_url, imdb_rating,
       metascore, rotten_tomatoes_score, imdb_votes, box_office_omdb, first_revenue_date,
       last_revenue_date, CAST(lifetime_revenue AS BIGINT) AS lifetime_revenue, omdb_fetched_at
FROM dim_movie"""

ORACLE: dict[str, str] = {
    "stg_dedupe_latest": sql(
        """SELECT id, revenue_date, title, CAST(revenue AS BIGINT) AS revenue,
                  CAST(theaters AS BIGINT) AS theaters, distributor FROM rev_latest""",
        "rev_latest"),
    "stg_release_year": sql(STG_OUT, "stg"),
    "json_flatten_doc": sql("SELECT * FROM docs_flat", "docs_flat"),
    "dim_distributor_build": sql(
        """SELECT distributor_key, distributor_name, films_distributed_n,
                  CAST(lifetime_revenue AS BIGINT) AS lifetime_revenue FROM dim_distributor""",
        "dim_distributor"),
    "dim_movie_build": sql(DIM_MOVIE_OUT, "dim_movie"),
    "fact_build": sql(
        """SELECT source_row_id, movie_key, date_key, distributor_key,
                  CAST(revenue AS BIGINT) AS revenue, CAST(theaters AS BIGINT) AS theaters,
                  revenue_date FROM fact""", "fact"),
    "revenue_by_director": sql(
        """SELECT m.director, CAST(sum(f.revenue) AS BIGINT) AS revenue
           FROM fact f LEFT JOIN dim_movie m ON f.movie_key = m.imdb_id
           GROUP BY m.director""", "fact", "dim_movie"),
}

# --- calendar -----------------------------------------------------------------------
CAL_COLS = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, left(monthname(d), 3) AS month_name,
       CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
       left(dayname(d), 3) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend"""

cte("dim_date_rev", f"""
  SELECT {CAL_COLS}
  FROM (SELECT CAST(t.ts AS DATE) AS d
        FROM (SELECT make_date(year(min(revenue_date)), 1, 1) AS lo,
                     make_date(year(max(revenue_date)), 12, 31) AS hi FROM stg) b,
             range(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP) + INTERVAL 1 DAY,
                   INTERVAL 1 DAY) t(ts))""", ("stg",))

# --- call log stand-in ----------------------------------------------------------------
cte("log", r"""
  SELECT event_id, ts AS call_at, user_id AS lookup_key,
    CASE WHEN event_type = 'error' AND value < 20 THEN 'error_timeout'
         WHEN event_type = 'error' AND value < 40 THEN 'error_other'
         WHEN event_type = 'error' AND value < 120 THEN 'error_429'
         WHEN event_type = 'error' AND value < 250 THEN 'error_5xx'
         WHEN event_type = 'error' THEN 'error_other'
         WHEN event_type = 'view' THEN 'not_found'
         WHEN event_type = 'signup' THEN 'error_other'
         ELSE 'found' END AS outcome,
    CAST(CASE WHEN event_type = 'error' AND value < 40 THEN NULL
              WHEN event_type = 'error' AND value < 120 THEN 429
              WHEN event_type = 'error' AND value < 250 THEN 503
              WHEN event_type = 'error' THEN 404
              ELSE 200 END AS INTEGER) AS http_status,
    CASE WHEN event_type = 'error' AND value < 20 THEN 'request timed out'
         WHEN event_type = 'error' AND value < 40 THEN 'connection reset by peer'
         WHEN event_type = 'error' AND value < 120 THEN 'rate limit'
         WHEN event_type = 'error' AND value < 250 THEN 'Service Unavailable'
         WHEN event_type = 'error' THEN 'Not Found'
         WHEN event_type = 'view' THEN 'Movie not found!'
         WHEN event_type = 'signup' THEN 'unexpected response shape'
         END AS error_message,
    value
  FROM events""")

cte("quota", r"""
  SELECT count(*) AS calls_today,
         greatest(0, 1000 - 50 - count(*)) AS remaining
  FROM log WHERE CAST(call_at AS DATE) = DATE '2024-01-30'""", ("log",))

cte("queue", r"""
  SELECT o_custkey AS lookup_key, CAST(year(any_value(first_date)) AS INTEGER) AS release_year,
         CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS lifetime_rev
  FROM (SELECT o_custkey, o_totalprice, min(o_orderdate) OVER (PARTITION BY o_custkey) AS first_date FROM orders) o
  WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = o_custkey AND event_type = 'purchase'
                                           AND ts < TIMESTAMP '2024-01-02 00:00:00')
    AND NOT EXISTS (SELECT 1 FROM log WHERE log.lookup_key = o_custkey AND starts_with(outcome, 'error')
                                        AND call_at >= TIMESTAMP '2024-01-30' AND call_at < TIMESTAMP '2024-01-31')
  GROUP BY o_custkey""", ("log",))

cte("mf", r"""
  SELECT * FROM dim_movie WHERE director IN ('Brand#13', 'Brand#22') AND genres = 'Standard'""",
    ("dim_movie",))
cte("ff", r"""
  SELECT * FROM fact WHERE movie_key IN (SELECT imdb_id FROM mf)""", ("fact", "mf"))

ORACLE.update({
    "revenue_by_distributor": sql(
        """SELECT distributor_name, CAST(sum(lifetime_revenue) AS BIGINT) AS lifetime_revenue
           FROM dim_distributor GROUP BY distributor_name""", "dim_distributor"),
    "film_table": sql(
        """SELECT m.title, m.director, m.genres, m.imdb_rating, m.rotten_tomatoes_score,
                  CAST(sum(f.revenue) AS BIGINT) AS revenue
           FROM fact f JOIN dim_movie m ON f.movie_key = m.imdb_id
           GROUP BY m.title, m.director, m.genres, m.imdb_rating, m.rotten_tomatoes_score
           HAVING sum(f.revenue) IS NOT NULL""", "fact", "dim_movie"),
    "kpi_cards": sql(
        """SELECT (SELECT CAST(sum(revenue) AS BIGINT) FROM fact) AS total_revenue,
                  (SELECT CAST(sum(revenue) AS DOUBLE) / 1000000 FROM fact) AS total_revenue_m,
                  (SELECT count(DISTINCT movie_key) + max(CASE WHEN movie_key IS NULL THEN 1 ELSE 0 END)
                   FROM fact) AS films_count,
                  (SELECT round(CAST(sum(revenue) AS DOUBLE) / count(revenue), 6) FROM fact) AS avg_daily_revenue,
                  (SELECT count(DISTINCT imdb_id) FROM dim_movie) AS films_enriched,
                  (SELECT round(CAST(sum(imdb_rating) AS DOUBLE) / count(imdb_rating), 6) FROM dim_movie)
                    AS avg_imdb_rating""", "fact", "dim_movie"),
    "date_range_text": sql(
        """SELECT strftime(min(revenue_date), '%Y-%m-%d') || '  →  ' ||
                  strftime(max(revenue_date), '%Y-%m-%d') AS date_range FROM fact""", "fact"),
    "top_film": sql(
        """SELECT string_agg(title, '' ORDER BY title) AS top_film
           FROM (SELECT m.title, sum(f.revenue) AS rev
                 FROM fact f JOIN dim_movie m ON f.movie_key = m.imdb_id GROUP BY m.title) t
           WHERE rev = (SELECT max(rev) FROM (SELECT m.title, sum(f.revenue) AS rev
                 FROM fact f JOIN dim_movie m ON f.movie_key = m.imdb_id GROUP BY m.title) u)""",
        "fact", "dim_movie"),
    "last_refresh": sql(
        """SELECT lr AS last_refresh, strftime(lr, '%Y-%m-%d %H:%M') AS last_refresh_text
           FROM (SELECT min(call_at) + CASE WHEN month(min(call_at)) BETWEEN 4 AND 10
                                            THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS lr
                 FROM log) t""", "log"),
    "revenue_drill": sql(
        """SELECT year, quarter_no,
                  CASE WHEN quarter_no IS NOT NULL THEN 'Qtr ' || CAST(quarter_no AS VARCHAR) END AS quarter,
                  month_no,
                  CASE WHEN month_no IS NOT NULL THEN monthname(make_date(2000, month_no, 1)) END AS month,
                  day, CAST(grouping(year, quarter_no, month_no, day) AS BIGINT) AS level,
                  CAST(sum(revenue) AS BIGINT) AS revenue
           FROM (SELECT CAST(year(revenue_date) AS INTEGER) AS year,
                        CAST(quarter(revenue_date) AS INTEGER) AS quarter_no,
                        CAST(month(revenue_date) AS INTEGER) AS month_no,
                        CAST(day(revenue_date) AS INTEGER) AS day, revenue FROM fact) t
           GROUP BY ROLLUP (year, quarter_no, month_no, day)""", "fact"),
    "revenue_drill_blank": sql(
        """SELECT year, quarter_no,
                  CASE WHEN quarter_no IS NOT NULL THEN 'Qtr ' || CAST(quarter_no AS VARCHAR) END AS quarter,
                  month_no,
                  CASE WHEN month_no IS NOT NULL THEN monthname(make_date(2000, month_no, 1)) END AS month,
                  day, CAST(grouping(year, quarter_no, month_no, day) AS BIGINT) AS level,
                  CAST(sum(revenue) AS BIGINT) AS revenue
           FROM (SELECT CASE WHEN known THEN CAST(year(revenue_date) AS INTEGER) END AS year,
                        CASE WHEN known THEN CAST(quarter(revenue_date) AS INTEGER) END AS quarter_no,
                        CASE WHEN known THEN CAST(month(revenue_date) AS INTEGER) END AS month_no,
                        CASE WHEN known THEN CAST(day(revenue_date) AS INTEGER) END AS day, revenue
                 FROM (SELECT *, revenue_date <= DATE '1996-12-31' AS known FROM fact)) t
           GROUP BY ROLLUP (year, quarter_no, month_no, day)""", "fact"),
    "filtered_kpi": sql(
        """SELECT (SELECT CAST(sum(revenue) AS BIGINT) FROM ff) AS total_revenue,
                  (SELECT CAST(sum(revenue) AS DOUBLE) / 1000000 FROM ff) AS total_revenue_m,
                  (SELECT count(DISTINCT movie_key) + max(CASE WHEN movie_key IS NULL THEN 1 ELSE 0 END)
                   FROM ff) AS films_count,
                  (SELECT round(CAST(sum(revenue) AS DOUBLE) / count(revenue), 6) FROM ff) AS avg_daily_revenue,
                  (SELECT count(DISTINCT imdb_id) FROM mf) AS films_enriched,
                  (SELECT round(CAST(sum(imdb_rating) AS DOUBLE) / count(imdb_rating), 6) FROM mf)
                    AS avg_imdb_rating""", "ff", "mf"),
    "cross_filter_star": sql(
        """SELECT m.director, CAST(sum(f.revenue) AS BIGINT) AS revenue
           FROM fact f
           JOIN dim_distributor d ON f.distributor_key = d.distributor_key
                                 AND d.distributor_name = 'Supplier#000000002'
           LEFT JOIN dim_movie m ON f.movie_key = m.imdb_id
           GROUP BY m.director""", "fact", "dim_movie", "dim_distributor"),
    "default_sums": """SELECT CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_l_quantity,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_l_extendedprice,
           CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS sum_l_discount,
           CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS sum_l_tax FROM lineitem""",
    "dim_date_build": sql(
        f"""SELECT {CAL_COLS}
            FROM (SELECT CAST(t.ts AS DATE) AS d
                  FROM (SELECT make_date(year(min(revenue_date)), 1, 1) AS lo,
                               make_date(year(max(revenue_date)), 12, 31) AS hi FROM raw_rev) b,
                       range(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP) + INTERVAL 1 DAY,
                             INTERVAL 1 DAY) t(ts))""", "raw_rev"),
    "queue_top_n": sql(
        """SELECT lookup_key, release_year, lifetime_rev FROM queue
           QUALIFY row_number() OVER (ORDER BY lifetime_rev DESC NULLS LAST, lookup_key)
                   <= (SELECT least(50, remaining) FROM quota)""", "queue", "quota"),
    "queue_preview": sql(
        """SELECT lookup_key, release_year, lifetime_rev FROM queue
           ORDER BY lifetime_rev DESC NULLS LAST, lookup_key LIMIT 5""", "queue"),
    "quota_remaining": sql(
        """SELECT calls_today, remaining, least(25, remaining) AS effective_limit FROM quota""",
        "quota"),
    "log_batch_append": sql(
        """SELECT event_id, call_at, lookup_key, outcome, http_status, error_message FROM log""", "log"),
    "outcome_counts": sql(
        """SELECT CASE WHEN outcome IN ('found', 'not_found') AND value >= 450 THEN 'error_other'
                       ELSE outcome END AS outcome, count(*) AS n
           FROM log GROUP BY 1""", "log"),
    "failure_breakdown": sql(
        """SELECT outcome, http_status, count(*) AS n FROM log
           WHERE outcome LIKE 'error%' GROUP BY outcome, http_status""", "log"),
    "step_profile": r"""
WITH s AS (
  SELECT CASE event_type WHEN 'view' THEN 'api' WHEN 'purchase' THEN 'api' WHEN 'click' THEN 's3'
                         WHEN 'signup' THEN 'log' ELSE 'total' END AS step, value
  FROM events),
r AS (
  SELECT step, value, row_number() OVER (PARTITION BY step ORDER BY value) - 1 AS idx,
         count(*) OVER (PARTITION BY step) AS n
  FROM s),
a AS (
  SELECT step, max(n) AS n, sum(value) AS total, max(value) AS mx,
         max(CASE WHEN idx = n // 2 THEN value END) AS p50,
         max(CASE WHEN idx = least(CAST(floor(n * CAST(0.95 AS DOUBLE)) AS BIGINT), n - 1)
                  THEN value END) AS p95
  FROM r GROUP BY step),
d AS (SELECT sum(total) AS denom FROM a WHERE step IN ('api', 's3', 'log'))
SELECT step, n, round(total / n * 1000, 3) AS mean_ms, p50 * 1000 AS p50_ms, p95 * 1000 AS p95_ms,
       mx * 1000 AS max_ms, round(total, 6) AS total_s,
       CASE WHEN step = 'total' THEN 100.0 WHEN denom > 0 THEN round(total / denom * 100, 3)
            ELSE 0.0 END AS pct
FROM a, d""",
    "title_normalise": r"""SELECT doc_id, regexp_replace(trim(text), '\s+', ' ', 'g') AS text_norm
                            FROM documents""",
    "events_json_field": """SELECT event_id, user_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
                            FROM events""",
    "ratings_pivot": """SELECT event_id, 'u' || CAST(user_id AS VARCHAR) AS imdb_id,
                               max(CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) END)
                                 OVER (PARTITION BY user_id) AS score
                        FROM events""",
    "record_id": """SELECT doc_id, rid AS record_id,
                           'raw/omdb/yyyy=2024/mm=01/dd=30/' || rid || '.json' AS object_path
                    FROM (SELECT doc_id,
                                 coalesce(CASE WHEN lang = 'en' THEN 'tt' || lpad(CAST(doc_id AS VARCHAR), 7, '0') END,
                                          'notfound_' || substr(sha1(text || '|' || CAST(n_chars AS VARCHAR)), 1, 12)) AS rid
                          FROM documents) t""",
    "freshness": sql(
        """SELECT source, max_loaded_at, age_hours,
                  CASE WHEN age_hours IS NULL OR age_hours > e THEN 'error' WHEN age_hours > w THEN 'warn' ELSE 'pass' END AS status
           FROM (
             SELECT 'raw.revenues' AS source, max(_loaded_at) AS max_loaded_at,
                    round((epoch_us(TIMESTAMP '2024-01-30 12:00:00') - epoch_us(max(_loaded_at))) / 3600000000.0, 6)
                      AS age_hours, 36 AS w, 72 AS e
             FROM raw_rev
             UNION ALL
             SELECT 'raw.omdb', max(_fetched_at),
                    round((epoch_us(TIMESTAMP '2024-01-30 12:00:00') - epoch_us(max(_fetched_at))) / 3600000000.0, 6),
                    168, 336
             FROM docs_flat
             UNION ALL SELECT 'raw.empty', NULL, NULL, 36, 72) t""",
        "raw_rev", "docs_flat"),
})


CHECKS_SQL = """SELECT check_name, failures,
       CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status
FROM (
  SELECT 'not_null_dim_movie_imdb_id' AS check_name, (SELECT count(*) FROM dim_movie WHERE imdb_id IS NULL) AS failures
  UNION ALL SELECT 'unique_dim_movie_imdb_id' AS check_name, (SELECT count(*) FROM (SELECT imdb_id FROM dim_movie WHERE imdb_id IS NOT NULL GROUP BY imdb_id HAVING count(*) > 1) t) AS failures
  UNION ALL SELECT 'accepted_range_dim_movie_imdb_rating' AS check_name, (SELECT count(*) FROM dim_movie WHERE NOT (imdb_rating >= 1.0 AND imdb_rating <= 10.0)) AS failures
  UNION ALL SELECT 'not_null_dim_date_date_key' AS check_name, (SELECT count(*) FROM dim_date_rev WHERE date_key IS NULL) AS failures
  UNION ALL SELECT 'unique_dim_date_date_key' AS check_name, (SELECT count(*) FROM (SELECT date_key FROM dim_date_rev WHERE date_key IS NOT NULL GROUP BY date_key HAVING count(*) > 1) t) AS failures
  UNION ALL SELECT 'not_null_dim_distributor_distributor_key' AS check_name, (SELECT count(*) FROM dim_distributor WHERE distributor_key IS NULL) AS failures
  UNION ALL SELECT 'unique_dim_distributor_distributor_key' AS check_name, (SELECT count(*) FROM (SELECT distributor_key FROM dim_distributor WHERE distributor_key IS NOT NULL GROUP BY distributor_key HAVING count(*) > 1) t) AS failures
  UNION ALL SELECT 'not_null_fact_source_row_id' AS check_name, (SELECT count(*) FROM fact WHERE source_row_id IS NULL) AS failures
  UNION ALL SELECT 'unique_fact_source_row_id' AS check_name, (SELECT count(*) FROM (SELECT source_row_id FROM fact WHERE source_row_id IS NOT NULL GROUP BY source_row_id HAVING count(*) > 1) t) AS failures
  UNION ALL SELECT 'not_null_fact_movie_key' AS check_name, (SELECT count(*) FROM fact WHERE movie_key IS NULL) AS failures
  UNION ALL SELECT 'relationships_fact_movie_key' AS check_name, (SELECT count(*) FROM fact c LEFT JOIN dim_movie p ON c.movie_key = p.imdb_id WHERE c.movie_key IS NOT NULL AND p.imdb_id IS NULL) AS failures
  UNION ALL SELECT 'not_null_fact_date_key' AS check_name, (SELECT count(*) FROM fact WHERE date_key IS NULL) AS failures
  UNION ALL SELECT 'relationships_fact_date_key' AS check_name, (SELECT count(*) FROM fact c LEFT JOIN dim_date_rev p ON c.date_key = p.date_key WHERE c.date_key IS NOT NULL AND p.date_key IS NULL) AS failures
  UNION ALL SELECT 'not_null_fact_distributor_key' AS check_name, (SELECT count(*) FROM fact WHERE distributor_key IS NULL) AS failures
  UNION ALL SELECT 'relationships_fact_distributor_key' AS check_name, (SELECT count(*) FROM fact c LEFT JOIN dim_distributor p ON c.distributor_key = p.distributor_key WHERE c.distributor_key IS NOT NULL AND p.distributor_key IS NULL) AS failures
  UNION ALL SELECT 'expression_is_true_fact_revenue' AS check_name, (SELECT count(*) FROM fact WHERE NOT (revenue >= 0)) AS failures
  UNION ALL SELECT 'unique_combination_stg_revenues' AS check_name, (SELECT count(*) FROM (SELECT revenue_date, title, distributor FROM stg GROUP BY revenue_date, title, distributor HAVING count(*) > 1) t) AS failures
  UNION ALL SELECT 'no_future_revenue_dates' AS check_name, (SELECT count(*) FROM fact WHERE revenue_date > DATE '2024-01-30') AS failures
) t"""

ORACLE["checks_summary"] = sql(CHECKS_SQL, "dim_movie", "dim_date_rev", "dim_distributor", "fact", "stg")

ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders"""
ORACLE.update({
    "csv_roundtrip": ORDERS_SQL,
    "json_partition_roundtrip": sql("SELECT * FROM docs_flat", "docs_flat"),
    "marts_table_roundtrip": ORACLE["fact_build"],
    "incremental_ingest": """SELECT o_orderkey, o_custkey,
           CASE WHEN year(o_orderdate) >= 1998 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN year(o_orderdate) >= 1998 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           o_orderdate, o_orderpriority FROM orders""",
    "ingest_restart": ORDERS_SQL,
    "pickup_once": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
           TIMESTAMP '2024-01-30 12:00:00' AS loaded_at,
           CASE WHEN year(o_orderdate) <= 1995 THEN 'a b' WHEN year(o_orderdate) <= 1997 THEN 'c%20d'
                ELSE chr(233) || ' [1]' END AS drop_name FROM orders""",
    "documents_once": sql("SELECT * FROM docs_flat", "docs_flat"),
    "log_stream": ORACLE["log_batch_append"],
    "distributor_ranking": sql(
        """SELECT distributor_name, CAST(lifetime_revenue AS BIGINT) AS lifetime_revenue,
                  row_number() OVER (ORDER BY lifetime_revenue DESC, distributor_name) AS position
           FROM dim_distributor""", "dim_distributor"),
    "months_in_order": sql(
        """SELECT monthname(make_date(2000, m, 1)) AS month, m AS month_no, r AS revenue,
                  row_number() OVER (ORDER BY m) AS position
           FROM (SELECT CAST(month(revenue_date) AS INTEGER) AS m, CAST(sum(revenue) AS BIGINT) AS r
                 FROM fact GROUP BY 1)""", "fact"),
    "kpi_text": sql(
        """SELECT '$' || format('{:,}', CAST(sum(revenue) AS BIGINT)) AS total_revenue,
                  '$' || replace(format('{:,}', CAST(floor(round(sum(revenue) / 1000000, 1)) AS BIGINT)), '-', '')
                      || right(CAST(CAST(round(CAST(sum(revenue) AS DECIMAL(30,6)) / 1000000, 1) AS DECIMAL(30,1))
                                    AS VARCHAR), 2) || 'M' AS total_revenue_m,
                  format('{:,}', count(DISTINCT movie_key)) AS films_count,
                  '$' || format('{:,}', CAST(round(sum(revenue) / count(revenue)) AS BIGINT)) AS avg_daily_revenue,
                  (SELECT format('{:,}', count(*)) FROM dim_movie) AS films_enriched,
                  (SELECT CAST(CAST(round(avg(imdb_rating), 1) AS DECIMAL(10,1)) AS VARCHAR) FROM dim_movie)
                    AS avg_imdb_rating FROM fact""", "fact", "dim_movie"),
    "calendar_spine": sql(
        """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, left(dayname(d), 3) AS day_name,
                  dayofweek(d) IN (0, 6) AS is_weekend, CAST(r AS BIGINT) AS revenue
           FROM (SELECT CAST(ts AS DATE) AS d FROM range(TIMESTAMP '1992-01-01', TIMESTAMP '2018-01-01',
                                                         INTERVAL 1 DAY) t(ts))
           LEFT JOIN (SELECT revenue_date, sum(revenue) AS r FROM fact GROUP BY 1) ON d = revenue_date""", "fact"),
    "filtered_film_table": sql(
        """SELECT title, director, genres, imdb_rating, rotten_tomatoes_score, CAST(sum(revenue) AS BIGINT) AS revenue
           FROM (SELECT m.* EXCLUDE (lifetime_revenue), f.revenue FROM dim_movie m JOIN fact f ON imdb_id = movie_key
                 WHERE release_year IN (1995, 1997) AND contains(lookup_title, '#1')
                   AND f.distributor_key IN (SELECT md5(s_name) FROM supplier WHERE s_name <= 'Supplier#000000050'))
           GROUP BY ALL""", "fact", "dim_movie"),
    "distributors_of_director": sql(
        """SELECT distributor_name, films_distributed_n FROM dim_distributor
           WHERE distributor_key IN (SELECT f.distributor_key FROM ff f WHERE theaters > 48)""",
        "ff", "dim_distributor"),
    "cross_filter_pairs": sql(
        """SELECT source, target, label, CAST(revenue AS BIGINT) AS revenue FROM (
             SELECT 'director' AS source, 'film' AS target, m.title AS label, sum(revenue) AS revenue
             FROM fact JOIN dim_movie m ON movie_key = imdb_id WHERE director = 'Brand#13' GROUP BY ALL
             UNION ALL
             SELECT 'director', 'distributor', distributor_name, lifetime_revenue FROM dim_distributor d
             WHERE EXISTS (SELECT 1 FROM fact JOIN dim_movie ON movie_key = imdb_id
                           WHERE director = 'Brand#13' AND fact.distributor_key = d.distributor_key)
             UNION ALL
             SELECT 'director', 'month', strftime(revenue_date, '%Y-%m'), sum(revenue)
             FROM fact WHERE movie_key IN (SELECT imdb_id FROM dim_movie WHERE director = 'Brand#13') GROUP BY ALL
             UNION ALL
             SELECT 'distributor', 'film', m.title, sum(revenue) FROM fact JOIN dim_movie m ON movie_key = imdb_id
             WHERE distributor_key = md5('Supplier#000000002') GROUP BY ALL
             UNION ALL
             SELECT 'distributor', 'director', director, sum(revenue) FROM fact JOIN dim_movie ON movie_key = imdb_id
             WHERE distributor_key = md5('Supplier#000000002') GROUP BY ALL
             UNION ALL
             SELECT 'film', 'month', strftime(revenue_date, '%Y-%m'), sum(revenue) FROM fact
             WHERE movie_key = 'tt0000007' GROUP BY ALL
             UNION ALL
             SELECT 'month', 'director', director, sum(revenue) FROM fact JOIN dim_movie ON movie_key = imdb_id
             WHERE year(revenue_date) = 1995 AND month(revenue_date) = 3 GROUP BY ALL)""",
        "fact", "dim_movie", "dim_distributor"),
    "staging_gate": sql(
        """SELECT check_name, failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
             SELECT unnest(['not_null_stg_revenues_id', 'not_null_stg_revenues_revenue_date',
                            'not_null_stg_revenues_title', 'not_negative_stg_revenues_revenue',
                            'unique_stg_revenues_id', 'unique_combination_stg_revenues']) AS check_name,
                    unnest([(SELECT count(*) - count(id) FROM stg), (SELECT count(*) - count(revenue_date) FROM stg),
                            (SELECT count(*) - count(title) FROM stg), (SELECT count(*) FROM stg WHERE revenue < 0),
                            (SELECT count(*) FROM (SELECT id FROM stg GROUP BY id HAVING count(*) > 1)),
                            (SELECT count(*) FROM (SELECT 1 FROM stg GROUP BY revenue_date, title, distributor
                                                   HAVING count(*) > 1))]) AS failures)""", "stg"),
})


_PART = "CASE WHEN coalesce(year(o_orderdate), 0) <= 1995 THEN 0 WHEN year(o_orderdate) <= 1997 THEN 1 ELSE 2 END"
ORACLE.update({
    "load_history": f"""WITH parts AS (
  SELECT {_PART} AS k, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM orders GROUP BY 1
), drops(drop_name, k, status) AS (VALUES
  ('1-first', 0, 'LOADED'), ('2-header-only', NULL, 'LOADED'), ('3-bad', NULL, 'FAILED'),
  ('4-mended', 1, 'LOADED'), ('5-last', 2, 'LOADED'))
SELECT drop_name, status, CASE WHEN status = 'LOADED' THEN coalesce(n, 0) END AS rows_loaded,
       coalesce(n, 0) AS rows_held, total
FROM drops LEFT JOIN parts USING (k)""",
    "merged_ingest": f"""SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 7 <= k THEN 'C' || k ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 7 <= k THEN o_totalprice + k ELSE o_totalprice END AS o_totalprice,
  o_orderdate, o_orderpriority
FROM (SELECT *, {_PART} AS k FROM orders)""",
    "call_log_batches": """WITH calls AS (
  SELECT event_id % 2 AS run, CASE event_type WHEN 'signup' THEN 'error_timeout' WHEN 'click' THEN 'error_429'
           WHEN 'view' THEN 'error_5xx' WHEN 'purchase' THEN CASE WHEN value < 450 THEN 'not_found' ELSE 'error_other' END
           ELSE 'error_other' END AS outcome
  FROM events
), sizes AS (SELECT run, count(*) AS n FROM calls GROUP BY run)
SELECT outcome, count(*) AS n_calls, any_value(n + 49) // 50 AS n_batches, any_value(n) AS n_rows,
       least(any_value(n), 50) AS largest
FROM calls JOIN sizes USING (run) GROUP BY run, outcome""",
})

ORACLE["incremental_star"] = sql("""
SELECT 'fact' AS kind, source_row_id AS key, movie_key AS other_key, date_key AS number,
       CAST(revenue AS BIGINT) AS revenue FROM fact
UNION ALL SELECT 'movie', imdb_id, lookup_title, CAST(release_year AS INTEGER), CAST(lifetime_revenue AS BIGINT) FROM dim_movie
UNION ALL SELECT 'distributor', distributor_key, NULL, CAST(films_distributed_n AS INTEGER),
       CAST(lifetime_revenue AS BIGINT) FROM dim_distributor""", "fact", "dim_movie", "dim_distributor")


def _summary(label: str, value: str, movies: str, facts: str, dists: str) -> str:
    """One row of a filter's effect; conditions on films (m), fact rows (f) and distributors (d)."""
    return f"""SELECT '{value}' AS {label}, CAST(sum(f.revenue) AS BIGINT) AS revenue, count(f.revenue_date) AS n_rows,
  count(DISTINCT f.movie_key) AS n_films, (SELECT count(*) FROM dim_movie m WHERE {movies}) AS n_movies,
  (SELECT count(*) FROM dim_distributor d WHERE {dists}) AS n_distributors
FROM fact f WHERE {facts}"""


_FACT_MOVIES = "EXISTS (SELECT 1 FROM dim_movie m WHERE m.imdb_id = f.movie_key AND {})"
_DIST_FACTS = "EXISTS (SELECT 1 FROM fact f WHERE f.distributor_key = d.distributor_key AND {})"


def _page() -> str:
    title, director = "upper(m.title) < 'M'", "m.director IN ('Brand#13', 'Brand#22')"
    year, names = "year(f.revenue_date) IN (1996, 1997)", "('Supplier#000000002', 'Supplier#000000003', 'Supplier#000000005')"
    own, fact_dist = f"d.distributor_name IN {names}", f"f.distributor_key IN (SELECT md5(s_name) FROM supplier WHERE s_name IN {names})"
    both = f"{title} AND {director}"
    every = f"{year} AND {fact_dist} AND {_FACT_MOVIES.format(both)}"
    rows = [_summary("filter", n, m, f, d) for n, m, f, d in (
        ("title", title, _FACT_MOVIES.format(title), _DIST_FACTS.format(_FACT_MOVIES.format(title))),
        ("year", "true", year, _DIST_FACTS.format(year)),
        ("director", director, _FACT_MOVIES.format(director), _DIST_FACTS.format(_FACT_MOVIES.format(director))),
        ("distributor", "true", fact_dist, own),
        ("all", both, every, f"{own} AND {_DIST_FACTS.format(every)}"),
        ("none", "true", "true", "true"))]
    return " UNION ALL ".join(rows)


def _roles() -> str:
    def quarter(c: str, y: int, q: int) -> str:
        return f"year({c}) = {y} AND quarter({c}) = {q}"

    rows = []
    for name, y, q in (("calendar_date", 1997, 2), ("calendar_revenue", 1996, 3)):
        own = quarter("f.revenue_date", y, q)
        rows.append(_summary("calendar", name, "true", own, _DIST_FACTS.format(own)))
    for name, c, y, q in (("calendar_first_revenue", "m.first_revenue_date", 1995, 1),
                          ("calendar_last_revenue", "m.last_revenue_date", 2001, 4),
                          ("calendar_fetched", "m.omdb_fetched_at", 2024, 1)):
        own = quarter(c, y, q)
        rows.append(_summary("calendar", name, own, _FACT_MOVIES.format(own), _DIST_FACTS.format(_FACT_MOVIES.format(own))))
    return " UNION ALL ".join(rows)


ORACLE["page_filters"] = sql(_page(), "fact", "dim_movie", "dim_distributor")
ORACLE["date_roles"] = sql(_roles(), "fact", "dim_movie", "dim_distributor")


cte("envelopes", """
  SELECT p.p_type, day(TIMESTAMP '2024-01-01 06:00:00' + (p.p_size - 1) * INTERVAL 1 DAY) % 2 = 0 AS even
  FROM films f JOIN first_part p ON f.title = p.title""", ("films", "first_part"))
ORACLE["frozen_listing"] = sql("""
SELECT 'written' AS stage, 0 AS n_docs, 0 AS n_corrected
UNION ALL SELECT 'refreshed', count(*) FILTER (even), 0 FROM envelopes
UNION ALL SELECT 'written again', count(*) FILTER (even), 0 FROM envelopes
UNION ALL SELECT 'refreshed again', count(*), count(*) FILTER (even AND p_type <> 'PROMO') FROM envelopes""", "envelopes")


#: CRC-32 of a short text, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
  regexp_extract_all(hex(encode({})), '..'), lambda x: ('0x' || x)::BIGINT)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""
cte("crc_table", """
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, x: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS t
  FROM range(256) r(i)""")
cte("drawn", f"""
  SELECT source_row_id, date_key, k, CASE k WHEN 0 THEN NULL WHEN 1 THEN 'tt-none' ELSE movie_key END AS movie_key,
         CASE k WHEN 2 THEN 'no such' ELSE distributor_key END AS distributor_key,
         CASE k WHEN 3 THEN -revenue ELSE revenue END AS revenue,
         CASE k WHEN 4 THEN revenue_date + 20000 ELSE revenue_date END AS revenue_date
  FROM (SELECT fact.*, {_CRC.format('source_row_id')} % 100 AS k FROM fact, crc_table)""", ("fact", "crc_table"))
cte("faulty", "SELECT * FROM drawn UNION ALL SELECT * FROM drawn WHERE k = 5", ("drawn",))
cte("flagged", """
  SELECT *, movie_key IS NULL AS a, date_key IS NULL AS b, coalesce(NOT revenue >= 0, false) AS c,
         coalesce(revenue_date > DATE '2024-01-30', false) AS d FROM faulty""", ("faulty",))
cte("passed", "SELECT * FROM flagged WHERE NOT (a OR b OR c OR d)", ("flagged",))
ORACLE["checks_while_writing"] = sql("""
SELECT check_name, CAST(failures AS BIGINT) AS failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
  SELECT 'not_null_fact_movie_key' AS check_name, count(*) FILTER (a) AS failures FROM flagged
  UNION ALL SELECT 'not_null_fact_date_key', count(*) FILTER (b) FROM flagged
  UNION ALL SELECT 'expression_is_true_fact_revenue', count(*) FILTER (c) FROM flagged
  UNION ALL SELECT 'no_future_revenue_dates', count(*) FILTER (d) FROM flagged
  UNION ALL SELECT 'quarantined', count(*) FILTER (a OR b OR c OR d) FROM flagged
  UNION ALL SELECT 'unique_fact_source_row_id', (SELECT count(*) FROM (
    SELECT 1 FROM passed GROUP BY source_row_id HAVING count(*) > 1))
  UNION ALL SELECT 'unique_dim_movie_imdb_id', (SELECT count(*) - count(DISTINCT imdb_id) FROM dim_movie)
  UNION ALL SELECT 'unique_dim_date_date_key', (SELECT count(*) - count(DISTINCT date_key) FROM dim_date_rev)
  UNION ALL SELECT 'unique_dim_distributor_distributor_key',
                   (SELECT count(*) - count(DISTINCT distributor_key) FROM dim_distributor)
  UNION ALL SELECT 'relationships_fact_movie_key', (SELECT count(*) FROM passed WHERE movie_key NOT IN (SELECT imdb_id FROM dim_movie))
  UNION ALL SELECT 'relationships_fact_date_key', (SELECT count(*) FROM passed WHERE date_key NOT IN (SELECT date_key FROM dim_date_rev))
  UNION ALL SELECT 'relationships_fact_distributor_key',
                   (SELECT count(*) FROM passed WHERE distributor_key NOT IN (SELECT distributor_key FROM dim_distributor)))""",
    "flagged", "passed", "dim_movie", "dim_date_rev", "dim_distributor")
ORACLE.update({
    "sketched_films": sql("""
SELECT 'distributor' AS level, distributor_key AS key, count(DISTINCT movie_key) AS n_films, count(*) AS n_rows,
       CAST(sum(revenue) AS BIGINT) AS revenue, true AS within_bound FROM fact GROUP BY distributor_key
UNION ALL SELECT 'year', CAST(year(revenue_date) AS VARCHAR), count(DISTINCT movie_key), count(*),
       CAST(sum(revenue) AS BIGINT), true FROM fact GROUP BY ALL""", "fact"),
    "footer_bounds": sql(" UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", CAST(min({c}) AS VARCHAR) AS lo, CAST(max({c}) AS VARCHAR) AS hi, "
        f"count(*) AS n_rows FROM {source}"
        for t, source, columns in (("fact_daily_revenue", "fact", ("revenue_date", "date_key")),
                                   ("stg_revenues", "stg", ("revenue_date", "release_year")),
                                   ("dim_date", "dim_date_rev", ("date", "year"))) for c in columns),
        "fact", "stg", "dim_date_rev"),
    "quota_stream": """SELECT CAST(ts AS DATE) AS day, count(*) AS n_calls, greatest(0, 950 - count(*)) AS remaining
FROM events GROUP BY 1""",
    "quoted_records": """SELECT doc_id, lang, source, md5(nullif(nullif(text, ''), '-')) AS text_md5, n_chars FROM documents""",
})
ORACLE["top_films"] = sql("""
SELECT title, CAST(revenue AS BIGINT) AS revenue FROM (
  SELECT m.title, sum(f.revenue) AS revenue, rank() OVER (ORDER BY sum(f.revenue) DESC) AS place
  FROM fact f JOIN dim_movie m ON m.imdb_id = f.movie_key GROUP BY m.title) WHERE place = 1""", "fact", "dim_movie")
