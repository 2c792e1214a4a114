"""Filter context: column filters that flow along the relations of the star.

The relations are data.  A filter on the one side of a relation keeps the rows
of the many side that belong to what it left; a relation that filters in both
directions also narrows the one side to what the many side has left.  For a
table asked for, the graph is walked once and every branch that holds a filter
becomes a semi-join: the engine broadcasts it when it measures it small, and
prunes the partitions of a fact partitioned by year, since the day relation
carries the year along.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from . import marts, measures


@dataclass(frozen=True)
class Relation:
    """Rows of ``many`` belong to the row of ``one`` with the same value; a filter flows from one to many.

    ``both``: it also flows back.  ``date_part``: the day of the many side's
    column counts.  ``along``: further equal columns, used where both tables
    have them (a partition column).
    """

    many: str
    many_col: str
    one: str
    one_col: str
    both: bool = False
    date_part: bool = False
    along: tuple[str, ...] = ()


FACT, MOVIE, DAY, DISTRIBUTOR = "fact_daily_revenue", "dim_movie", "dim_date", "dim_distributor"
# The relations of the report's model; each date column has a calendar of its own.
STAR_RELATIONS = (
    Relation(FACT, "distributor_key", DISTRIBUTOR, "distributor_key", both=True),
    Relation(FACT, "date_key", DAY, "date_key", along=("year",)),
    Relation(FACT, "movie_key", MOVIE, "imdb_id"),
    Relation(DAY, "date", "calendar_date", "date", date_part=True),
    Relation(MOVIE, "first_revenue_date", "calendar_first_revenue", "date", date_part=True),
    Relation(MOVIE, "last_revenue_date", "calendar_last_revenue", "date", date_part=True),
    Relation(MOVIE, "omdb_fetched_at", "calendar_fetched", "date", date_part=True),
    Relation(FACT, "revenue_date", "calendar_revenue", "date", date_part=True, along=("year",)),
)
# The columns that the report's page may be filtered by.
PAGE_FILTERS = {"title": (MOVIE, "title"), "year": (DAY, "year"), "director": (MOVIE, "director"),
                "distributor": (DISTRIBUTOR, "distributor_name")}
# Fixed values: (picked in, filtered) visuals.
INTERACTIONS = (("director", "film"), ("director", "distributor"), ("director", "month"), ("distributor", "film"),
                ("distributor", "director"), ("film", "month"), ("month", "director"))


def star_model(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The star with a calendar for each date column, padded to whole years of its dates."""
    out = dict(tables)
    for r in STAR_RELATIONS:
        if r.date_part and r.one not in out:
            days = out[r.many].select(F.to_date(r.many_col).alias("day"))
            out[r.one] = marts.dim_date_from(D.year_padded_bounds(days, "day"))
    return out


def year_partitioned(fact: DataFrame, path: str) -> DataFrame:
    """The fact written in a partition per year (``year``, from its day key); a year is as many files as its bytes ask for."""
    year = F.expr("date_key div 10000").cast("int")
    fact.withColumn("year", year).hint("rebalance", "year").write.partitionBy("year").parquet(path)
    return fact.sparkSession.read.parquet(path)


def matches(column: str, value) -> Column:
    """A column filter: a value, a list of values, or a function of the column."""
    c = F.col(column)
    if callable(value):
        return value(c)
    if isinstance(value, (list, tuple, set, frozenset)):
        return c.isin(*value)
    return c.isNull() if value is None else c == value


@dataclass(frozen=True)
class FilterContext:
    """Tables, their relations and filters {table: [conditions]}; every method leaves it as it is."""

    tables: Mapping[str, DataFrame]
    relations: Sequence[Relation] = STAR_RELATIONS
    filters: Mapping[str, tuple[Column, ...]] = field(default_factory=dict)

    def where(self, table: str, *conditions: Column) -> FilterContext:
        """With further conditions on a table; all conditions hold together."""
        if table not in self.tables:
            raise KeyError(f"no table {table}")
        own = (*self.filters.get(table, ()), *conditions)
        return FilterContext(self.tables, self.relations, {**self.filters, table: own})

    def page(self, **values) -> FilterContext:
        """With page filters by name (see ``PAGE_FILTERS``); an absent or empty list is no filter."""
        out = self
        for name, value in values.items():
            table, column = PAGE_FILTERS[name]
            if not (isinstance(value, (list, tuple, set)) and not value):
                out = out.where(table, matches(column, value))
        return out

    def _flows(self, table: str, came: Relation | None = None):
        """(relation, table that filters, its column, own column) of the neighbours whose filters reach ``table``."""
        for r in self.relations:
            if r is came or r.one not in self.tables or r.many not in self.tables:
                continue
            if r.many == table:
                yield r, r.one
            elif r.one == table and r.both:
                yield r, r.many

    def _filtered(self, table: str, came: Relation | None = None) -> bool:
        return bool(self.filters.get(table)) or any(self._filtered(t, r) for r, t in self._flows(table, came))

    def rows(self, table: str, came: Relation | None = None) -> DataFrame:
        """The rows of ``table`` that all filters leave."""
        out = self.tables[table]
        for condition in self.filters.get(table, ()):
            out = out.where(condition)
        for r, other in self._flows(table, came):
            if not self._filtered(other, r):
                continue
            own, far = (r.many_col, r.one_col) if r.many == table else (r.one_col, r.many_col)
            along = [c for c in r.along if c in self.tables[r.many].columns and c in self.tables[r.one].columns]
            left = self.rows(other, r).select(F.col(far).alias("_far"), *[F.col(c).alias(f"_far_{c}") for c in along])
            if r.date_part:  # the day on the many side; calendars hold days
                left = left.withColumn("_far", F.to_date("_far"))
            if r.many == other:
                left = left.distinct()  # with map-side combine: a hot key is one row of the join
            on = [(F.to_date(own) if r.date_part else F.col(own)) == F.col("_far")]
            out = out.join(left, on + [out[c] == F.col(f"_far_{c}") for c in along], "left_semi")
        return out

    # --- visuals ------------------------------------------------------------------

    def chart(self, visual: str) -> DataFrame:
        """label, revenue of a visual of the report: director, film, distributor or month."""
        if visual == "distributor":  # the dimension's own lifetime revenue
            out = measures.revenue_by_distributor(self.rows(DISTRIBUTOR)).select(
                F.col("distributor_name").alias("label"), F.col("lifetime_revenue").alias("revenue"))
        elif visual == "month":
            out = self.rows(FACT).groupBy(F.date_format("revenue_date", "yyyy-MM").alias("label")).agg(
                F.sum("revenue").alias("revenue"))
        elif visual in ("director", "film"):
            attr = "director" if visual == "director" else "title"
            # Without a movie a row is in the blank group; a film without revenue is hidden.
            how = "left" if visual == "director" else "inner"
            out = measures.revenue_by_attribute(self.rows(FACT), self.tables[MOVIE], attr, how).select(
                F.col(attr).alias("label"), "revenue")
        else:
            raise KeyError(visual)
        return out.select("label", F.col("revenue").cast("bigint").alias("revenue"))

    def summary(self) -> DataFrame:
        """One row: revenue, rows and films of the fact, films and distributors that the filters leave."""
        parts = (self.rows(FACT).agg(F.sum("revenue").cast("bigint").alias("revenue"), F.count(F.lit(1)).alias("n_rows"),
                                     F.count_distinct("movie_key").alias("n_films")),
                 self.rows(MOVIE).agg(F.count(F.lit(1)).alias("n_movies")),
                 self.rows(DISTRIBUTOR).agg(F.count(F.lit(1)).alias("n_distributors")))
        out = parts[0]
        for one in parts[1:]:  # three rows, each with its own columns
            out = out.unionByName(one, allowMissingColumns=True)
        return out.agg(*[F.max(c).alias(c) for c in out.columns])


def interact(context: FilterContext, picks: Mapping[str, tuple[str, Column]],
             pairs: Sequence[tuple[str, str]] = INTERACTIONS) -> DataFrame:
    """source, target, label, revenue: each target visual under what is picked in the source visual.

    ``picks``: by visual, the table and condition that the picked value stands for.
    """
    out = None
    for source, target in pairs:
        table, condition = picks[source]
        one = context.where(table, condition).chart(target).select(
            F.lit(source).alias("source"), F.lit(target).alias("target"), "label", "revenue")
        out = one if out is None else out.unionByName(one)
    return out
