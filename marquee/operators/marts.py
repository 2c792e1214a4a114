"""Star schema: calendar, distributor and movie dimensions, daily fact.

Plan shape
----------
* ``dim_distributor``: ``count(DISTINCT title)`` + ``sum`` per distributor.
  Catalyst rewrites the distinct aggregate into two hash aggregates keyed
  (distributor, title) then (distributor), both with map-side partials, so
  a distributor carrying a third of all rows never meets one task unfolded.
* ``dim_movie``: aggregate revenue per (title, release_year) *before* the
  join with the (much smaller) document table.
* ``fact``: staged rows joined to the two dimensions.  Both dims have one
  row per natural key; AQE broadcasts them when their shuffled size is below
  ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keeps a
  sort-merge join with skew splitting.  Neither dim is hinted blindly.
* ``dim_date``: bounded by its date range (days), so it is the one dimension
  broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import keys as K


def dim_date(spark, start: str = D.DEFAULT_SPINE_START,
             end_exclusive: str = D.DEFAULT_SPINE_END) -> DataFrame:
    """Calendar [start, end) with key, parts, names and weekend flag."""
    return D.spine(spark, start, end_exclusive).select(*D.calendar_columns("date_day"))


def dim_date_from(bounds: DataFrame) -> DataFrame:
    """Calendar over a one-row (lo, hi) frame, both ends inclusive."""
    return D.spine_between(bounds).select(*D.calendar_columns("date_day"))


def dim_distributor(stg: DataFrame) -> DataFrame:
    """One row per distributor: md5 key, films distributed, lifetime revenue."""
    base = (stg.where(F.col("distributor").isNotNull())
            .groupBy("distributor")
            .agg(F.count_distinct("title").alias("films_distributed_n"),
                 F.sum("revenue").alias("lifetime_revenue")))
    return base.select(K.md5_key("distributor").alias("distributor_key"),
                       F.col("distributor").alias("distributor_name"),
                       "films_distributed_n", "lifetime_revenue")


def revenues_by_film(stg: DataFrame) -> DataFrame:
    return stg.groupBy("title", "release_year").agg(
        F.min("revenue_date").alias("first_revenue_date"),
        F.max("revenue_date").alias("last_revenue_date"),
        F.sum("revenue").alias("lifetime_revenue"))


DIM_MOVIE_COLUMNS = (
    "imdb_id", "title", "lookup_title", "release_year", "runtime_min", "genres", "director",
    "writer", "actors", "plot", "languages", "country", "rated", "awards", "poster_url",
    "imdb_rating", "metascore", "rotten_tomatoes_score", "imdb_votes", "box_office_omdb",
    "first_revenue_date", "last_revenue_date", "lifetime_revenue", "omdb_fetched_at")


def dim_movie(stg: DataFrame, docs: DataFrame) -> DataFrame:
    """Enriched films only (inner join on the normalised title and first year).

    Two documents for one lookup fan the film out into two rows; the unique
    check on ``imdb_id`` reports it rather than this builder hiding it.
    """
    r = revenues_by_film(stg).alias("r")
    o = docs.alias("o")
    joined = r.join(o, (F.col("r.title") == F.col("o.lookup_title"))
                    & (F.col("r.release_year") == F.col("o.lookup_year")), "inner")
    cols = {
        "imdb_id": F.col("o.imdb_id"),
        "title": F.coalesce(F.col("o.title"), F.col("r.title")),
        "lookup_title": F.col("r.title"),
        "release_year": F.col("r.release_year"),
        "first_revenue_date": F.col("r.first_revenue_date"),
        "last_revenue_date": F.col("r.last_revenue_date"),
        "lifetime_revenue": F.col("r.lifetime_revenue"),
        "omdb_fetched_at": F.col("o._fetched_at"),
    }
    return joined.select(*[cols.get(c, F.col("o." + c)).alias(c) for c in DIM_MOVIE_COLUMNS])


def fact_daily_revenue(stg: DataFrame, movies: DataFrame, distributors: DataFrame,
                       carry: dict[str, str] | None = None) -> DataFrame:
    """Revenue rows of enriched films with a known distributor, keyed to the dims.

    ``carry``: further columns {name: staged column} that are put first.
    """
    m = movies.select(F.col("imdb_id").alias("movie_key"),
                      F.col("lookup_title").alias("_m_title"),
                      F.col("release_year").alias("_m_year"))
    d = distributors.select("distributor_key", F.col("distributor_name").alias("_d_name"))
    r = stg.alias("r")
    j = (r.join(m, (F.col("r.title") == F.col("_m_title"))
                & (F.col("r.release_year") == F.col("_m_year")), "inner")
          .join(d, F.col("r.distributor") == F.col("_d_name"), "inner"))
    return j.select(*[F.col(f"r.{c}").alias(n) for n, c in (carry or {}).items()],
                    F.col("r.id").alias("source_row_id"), "movie_key",
                    D.date_key("r.revenue_date").alias("date_key"),
                    "distributor_key", F.col("r.revenue"), F.col("r.theaters"),
                    F.col("r.revenue_date"))


def build_marts(stg: DataFrame, docs: DataFrame, calendar: DataFrame) -> dict[str, DataFrame]:
    """All four mart tables from the staged inputs (lazy; write them to reuse)."""
    movies = dim_movie(stg, docs)
    dists = dim_distributor(stg)
    return {
        "dim_date": calendar,
        "dim_movie": movies,
        "dim_distributor": dists,
        "fact_daily_revenue": fact_daily_revenue(stg, movies, dists),
    }


# Tables written clustered by a column: parquet keeps min/max per row group,
# so a date-filtered read skips the row groups outside the range.
CLUSTER_BY = {"fact_daily_revenue": "revenue_date", "stg_revenues": "revenue_date"}
MAX_RECORDS_PER_FILE = 20_000_000


def materialize(spark, tables: dict[str, DataFrame], root: str | None = None) -> dict[str, DataFrame]:
    """Write each table once (parquet, shared checkpoint folder) and read it back.

    Cuts the lineage: checks and reports that read several marts scan the
    written tables instead of re-running the whole build per consumer, and a
    lost executor re-reads files instead of recomputing the star.  Fact-like
    tables are dealt by month and sorted by date inside each task: a task has
    one partition of the advisory size however large its input split was, so
    the sort stays in memory, and a file holds few months.  Files are capped
    at ``MAX_RECORDS_PER_FILE`` rows.
    """
    from ..session import scratch_path
    base = root or scratch_path(spark, "marts")
    out = {}
    for name, df in tables.items():
        path = f"{base}/{name}"
        if CLUSTER_BY.get(name) in df.columns:
            by = CLUSTER_BY[name]
            df = df.withColumn("_month", F.trunc(by, "month")).hint("rebalance", "_month").sortWithinPartitions(by).drop("_month")
        df.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)
        out[name] = spark.read.parquet(path)
    return out


# Co-location of the report joins: fact and movie dimension bucketed on the
# movie key with the same bucket count (scale the count with the fact size,
# e.g. thousands of buckets for a 100 TB fact).
STAR_BUCKETS = {"fact_daily_revenue": "movie_key", "dim_movie": "imdb_id"}


def publish(spark, views: dict[str, DataFrame], tables: dict[str, DataFrame], root: str,
            prefix: str = "", buckets: dict[str, str] | None = None,
            num_buckets: int = 64) -> dict[str, DataFrame]:
    """Staging as views, marts as tables (external, below ``root``).

    ``buckets`` maps table -> column: such a table is written with
    ``bucketBy(num_buckets, column)``.  Two tables bucketed alike on their
    join keys are joined, and grouped by that key, without a shuffle.
    Returns every object re-read by name through the catalog, the way a
    downstream model or the reporting layer references it.
    """
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    for name, df in tables.items():
        w = df.write.mode("overwrite").option("path", f"{root}/{name}")
        if buckets and name in buckets:
            w = w.bucketBy(num_buckets, buckets[name]).sortBy(buckets[name])
        w.saveAsTable(prefix + name)
    return {n: spark.table(prefix + n) for n in [*views, *tables]}
