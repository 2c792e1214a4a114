"""Report measures and visuals over the star schema.

Every report aggregates the fact to the grain of the dimension it needs
(movie, day) *before* joining, so the join sees one row per key instead of
one row per fact row; the dimension join is then cheap whichever strategy
AQE picks.  Nothing here uses an un-partitioned window: "top" is a max
aggregate joined back (one-row side, broadcast by construction).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates as D
from ..session import scratch_path

# Text between the two dates of the range card, and formats.
DATE_RANGE_SEPARATOR = "  →  "
DATE_FMT = "yyyy-MM-dd"
REFRESH_FMT = "yyyy-MM-dd HH:mm"


def revenue_per_movie(fact: DataFrame) -> DataFrame:
    return fact.groupBy("movie_key").agg(F.sum("revenue").alias("revenue"))


def revenue_by_attribute(fact: DataFrame, movies: DataFrame, attr: str,
                         how: str = "left") -> DataFrame:
    """Revenue per movie attribute; a fact row without movie goes to the NULL group."""
    per_movie = revenue_per_movie(fact)
    m = movies.select(F.col("imdb_id").alias("movie_key"), attr)
    return (per_movie.join(m, "movie_key", how)
            .groupBy(attr).agg(F.sum("revenue").alias("revenue"))
            .orderBy(F.desc("revenue"), F.asc(attr)))


def revenue_by_director(fact: DataFrame, movies: DataFrame) -> DataFrame:
    return revenue_by_attribute(fact, movies, "director")


def revenue_by_distributor(distributors: DataFrame) -> DataFrame:
    """From the dimension's lifetime revenue (includes unenriched films)."""
    return (distributors.groupBy("distributor_name")
            .agg(F.sum("lifetime_revenue").alias("lifetime_revenue"))
            .orderBy(F.desc("lifetime_revenue"), "distributor_name"))


FILM_TABLE_GROUP = ("title", "director", "genres", "imdb_rating", "rotten_tomatoes_score")


def film_table(fact: DataFrame, movies: DataFrame,
               group: Sequence[str] = FILM_TABLE_GROUP) -> DataFrame:
    """Films with their revenue; groups without revenue are hidden."""
    per_movie = revenue_per_movie(fact)
    m = movies.select(F.col("imdb_id").alias("movie_key"), *group)
    return (per_movie.join(m, "movie_key", "inner")
            .groupBy(*group).agg(F.sum("revenue").alias("revenue"))
            .where(F.col("revenue").isNotNull())
            .orderBy(F.desc("revenue"), *group))


def distinct_count_blank(c: str) -> Column:
    """Distinct count that, like the BI engine, counts a NULL (blank) as a value."""
    return F.count_distinct(c) + F.max(F.when(F.col(c).isNull(), 1).otherwise(0))


def kpi_cards(fact: DataFrame, movies: DataFrame) -> DataFrame:
    """One row: total revenue, in millions, films counted, enriched, averages.

    The fact is aggregated once per movie (a hash aggregate with map-side
    partials - no ``Expand`` of fact rows for the distinct count): the
    number of movie groups *is* the distinct count, and the totals are sums
    of the per-movie sums.  The dimension side is a separate small
    aggregate; the two one-row results are put side by side with a union and
    ``max`` (no join, no cross join).
    """
    per_movie = fact.groupBy("movie_key").agg(F.sum("revenue").alias("s"),
                                              F.count("revenue").alias("n"))
    f = per_movie.agg(
        F.sum("s").alias("total"), F.sum("n").alias("n_rev"),
        (F.count("movie_key") + F.max(F.when(F.col("movie_key").isNull(), 1).otherwise(0)))
        .alias("films"))
    m = movies.agg(F.count_distinct("imdb_id").alias("enriched"),
                   F.sum("imdb_rating").alias("rating_sum"), F.count("imdb_rating").alias("rating_n"))
    cols = {"total": f.schema["total"].dataType, "n_rev": "long", "films": "long",
            "enriched": "long", "rating_sum": m.schema["rating_sum"].dataType, "rating_n": "long"}

    def widen(df: DataFrame) -> DataFrame:
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
                           for c, t in cols.items()])

    one = widen(f).unionByName(widen(m)).agg(*[F.max(c).alias(c) for c in cols])
    return one.select(
        F.col("total").cast("bigint").alias("total_revenue"),
        F.try_divide(F.col("total"), F.lit(1000000)).cast("double").alias("total_revenue_m"),
        F.col("films").alias("films_count"),
        F.round(F.col("total").cast("double") / F.col("n_rev"), 6).alias("avg_daily_revenue"),
        F.col("enriched").alias("films_enriched"),
        F.round(F.col("rating_sum").cast("double") / F.col("rating_n"), 6).alias("avg_imdb_rating"),
    )


def kpi_cards_text(kpis: DataFrame) -> DataFrame:
    """The KPI row as the cards display it."""
    from ..functions import formats as FM
    return kpis.select(
        FM.money("total_revenue").alias("total_revenue"),
        FM.money_millions("total_revenue_m").alias("total_revenue_m"),
        FM.whole_number("films_count").alias("films_count"),
        FM.money("avg_daily_revenue").alias("avg_daily_revenue"),
        FM.whole_number("films_enriched").alias("films_enriched"),
        FM.one_decimal("avg_imdb_rating").alias("avg_imdb_rating"))


def date_range_text(fact: DataFrame) -> DataFrame:
    return fact.agg(F.concat(F.date_format(F.min("revenue_date"), DATE_FMT),
                             F.lit(DATE_RANGE_SEPARATOR),
                             F.date_format(F.max("revenue_date"), DATE_FMT)).alias("date_range"))


def top_films(fact: DataFrame, movies: DataFrame) -> DataFrame:
    """The title(s) with the highest revenue, one row each: any number of ties."""
    per_title = (revenue_per_movie(fact)
                 .join(movies.select(F.col("imdb_id").alias("movie_key"), "title"), "movie_key")
                 .groupBy("title").agg(F.sum("revenue").alias("revenue")))
    best = per_title.agg(F.max("revenue").alias("revenue"))  # one row
    return per_title.join(F.broadcast(best), "revenue", "left_semi")


def top_film(fact: DataFrame, movies: DataFrame, max_ties: int = 10_000) -> DataFrame:
    """Title(s) with the highest revenue; ties concatenated without delimiter."""
    winners = top_films(fact, movies)
    # The text is one value, so its ties meet in one task; more than max_ties
    # of them fail rather than give a cut text (``top_films`` lists any number).
    ties = winners.limit(max_ties + 1)
    text = F.expr("listagg(title, '') WITHIN GROUP (ORDER BY title)")
    failed = F.raise_error(F.lit(f"more than {max_ties} titles tie for the top")).cast("string")
    return ties.agg(F.when(F.count(F.lit(1)) <= max_ties, text).otherwise(failed).alias("top_film"))


def exact_mean(c: str) -> Column:
    """Mean as (exact decimal sum) / count, in double.

    A decimal ``avg`` is rounded to the input scale + 4 digits; dividing the
    exact sum keeps full double precision and is independent of row order.
    """
    return F.sum(c).cast("double") / F.count(c)


def avg_rating(movies: DataFrame) -> DataFrame:
    return movies.agg(F.round(exact_mean("imdb_rating"), 6).alias("avg_imdb_rating"))


def last_refresh(refreshes: DataFrame, ts: str = "refreshed_at") -> DataFrame:
    """Earliest refresh shown in local time (+2 h Apr..Oct, else +1 h)."""
    local = D.local_from_utc_dst_approx(F.min(ts))
    return refreshes.agg(local.alias("last_refresh")).select(
        "last_refresh", F.date_format("last_refresh", REFRESH_FMT).alias("last_refresh_text"))


def default_sums(df: DataFrame, cols: Sequence[str], exact_scale: int | None = None) -> DataFrame:
    """Implicit SUM of columns flagged 'summarize by sum', in each column's own type.

    A caller whose floating columns hold decimals of a known scale may name
    it: they are then summed exactly, in any order of rows.
    """
    out = []
    for c in cols:
        x = F.col(c)
        if exact_scale is not None and dict(df.dtypes)[c] in ("double", "float"):
            x = x.cast(f"decimal(18,{exact_scale})")
        out.append(F.sum(x).alias(f"sum_{c}"))
    return df.agg(*out)


def revenue_drill(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Revenue over Year > Quarter > Month > Day with subtotals (ROLLUP).

    The fact is first folded to one row per day, then joined to the
    calendar by the date part, so the rollup's Expand runs over days, not
    over fact rows.
    """
    per_day = fact.groupBy(F.to_date("revenue_date").alias("date")).agg(
        F.sum("revenue").alias("revenue"))
    cal = calendar.select(F.col("date"), F.col("year"), F.col("quarter").alias("quarter_no"),
                          F.col("month").alias("month_no"), F.col("day"))
    # Days outside of the calendar go to a blank group; no revenue is lost.
    days = per_day.join(F.broadcast(cal), "date", "left")
    r = days.rollup("year", "quarter_no", "month_no", "day").agg(
        F.sum("revenue").alias("revenue"), F.grouping_id().alias("level"))
    return r.select(
        "year", "quarter_no",
        F.when(F.col("quarter_no").isNotNull(), D.quarter_label("quarter_no")).alias("quarter"),
        "month_no",
        F.when(F.col("month_no").isNotNull(), D.month_full_name("month_no")).alias("month"),
        "day", "level", "revenue",
    ).orderBy("level", "year", "quarter_no", "month_no", "day")


def ranked(report: DataFrame, *order: Column, position: str = "position") -> DataFrame:
    """A report with the place of each row, from 1, in the sort by ``order``.

    The rows are sorted by ranges and numbered by range and place, so no task
    sees more than its range and one row for each other range.
    """
    rows = report.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = _kept(rows.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
                .withColumn(position, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1)
                .drop("_at", "_part", "_before"))


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filter_movies(movies: DataFrame, **equals) -> DataFrame:
    """Report filters on dimension columns: ``column=value`` or ``column=[values]``."""
    out = movies
    for c, v in equals.items():
        out = out.where(F.col(c).isin(*v) if isinstance(v, (list, tuple, set)) else F.col(c) == v)
    return out


def restrict_fact(fact: DataFrame, movies: DataFrame | None = None,
                  distributors: DataFrame | None = None,
                  calendar: DataFrame | None = None) -> DataFrame:
    """Keep fact rows whose movie / distributor / day is in the (filtered) dims.

    Each selection is a ``left_semi`` join (EXISTS): the fact is never
    multiplied, NULL keys never match, and a small selection is broadcast by
    AQE after its size is measured.
    """
    out = fact
    if movies is not None:
        out = out.join(movies.select(F.col("imdb_id").alias("movie_key")), "movie_key", "left_semi")
    if distributors is not None:
        out = out.join(distributors.select("distributor_key"), "distributor_key", "left_semi")
    if calendar is not None:
        out = out.join(calendar.select("date_key"), "date_key", "left_semi")
    return out


def cross_filter_dim(dim: DataFrame, dim_key: str, fact: DataFrame, fact_key: str) -> DataFrame:
    """Both-directions filter: the dim rows that still have fact rows.

    The fact's keys are made distinct first (with map-side combine), so a hot
    key is one row of the join.
    """
    return dim.join(fact.select(F.col(fact_key).alias(dim_key)).distinct(), dim_key, "left_semi")


# --- distinct counts that can be united ---------------------------------------------------

#: Bits of a sketch's registers: 2**12 of them, a relative standard error of 1.04 / 64.
SKETCH_BITS = 12


def film_sketches(fact: DataFrame, *by: str) -> DataFrame:
    """Per group of ``by`` (default day and distributor) a mergeable sketch of its films, and what adds up.

    Sketches of any groups can be united, so one small table serves the distinct
    counts under every filter of its columns; each is of bounded size.
    """
    by = by or ("date_key", "distributor_key")
    return fact.groupBy(*by).agg(F.hll_sketch_agg("movie_key", F.lit(SKETCH_BITS)).alias("films"),
                                 F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("n_rows"))


def estimated_films(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimated distinct films (and exact sums) per group of ``by``, from united sketches; see ``kpi_cards`` for exact counts."""
    return sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("films")).alias("films_estimate"),
        F.sum("revenue").alias("revenue"), F.sum("n_rows").alias("n_rows"))


# --- bounds without reading rows ------------------------------------------------------------

#: Settings under which minima, maxima and counts of whole Parquet columns come from the files' footers.
FOOTER_CONF = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
               "spark.sql.parquet.aggregatePushdown": "true"}


def footer_bounds(spark: SparkSession, path: str, *columns: str, plan: list | None = None) -> DataFrame:
    """column, lo, hi, n_rows of date and whole-number columns, from file statistics: no row is read.

    Other types have no exact statistics in all files and are refused.  The
    settings hold for this one read.  ``plan`` gets the executed plan's text.
    """
    before = {k: spark.conf.get(k, None) for k in FOOTER_CONF}
    try:
        for k, v in FOOTER_CONF.items():
            spark.conf.set(k, v)
        table = spark.read.parquet(path)
        kinds = dict(table.dtypes)
        for c in columns:
            if kinds[c] not in ("date", "tinyint", "smallint", "int", "bigint"):
                raise TypeError(f"{c} is {kinds[c]}: no exact statistics")
        wanted = [f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))]
        bounds = table.agg(*wanted, F.count(F.lit(1)).alias("n"))
        if plan is not None:
            plan.append(bounds._jdf.queryExecution().toString())
        row = bounds.first()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    rows = [(c, *(None if row[f"{n}{i}"] is None else str(row[f"{n}{i}"]) for n in ("lo", "hi")), row["n"])
            for i, c in enumerate(columns)]
    return spark.createDataFrame(rows, "column string, lo string, hi string, n_rows bigint")
