"""Staging layer: typed, cleaned, de-duplicated revenue rows and flat documents.

Plan shape (what Catalyst is given)
-----------------------------------
* latest-wins de-dup shuffles the rows by key first and then takes
  ``groupBy(id).agg(max(struct(order..., row...)))`` in each partition: the
  struct buffer is not fixed-width, so the aggregate sorts, and a sort before
  the shuffle would hold a whole input split.  Keys that would fill more than
  a partition (counted by a hash of the key) go another way: they are folded
  to one row per map task before their shuffle, so an id repeated a billion
  times never meets in one task.
* the per-title first year is ``groupBy(title).min`` joined back on title.
  The aggregate side has one row per title; AQE turns the join into a
  broadcast when that side is measured small after its shuffle, and splits a
  hot title's partition (skew join) when it is not.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import json as J
from ..functions import text as T
from ..session import delete_file, folder_bytes, rounds_of, scratch_path

REVENUE_COLUMNS = ("id", "revenue_date", "title", "revenue", "theaters", "distributor")
# Accepted document status / type, and the ratings source read.
STATUS_FOUND = "found"
TYPE_MOVIE = "movie"
RATINGS_SOURCE = "Rotten Tomatoes"


def dedupe_latest(df: DataFrame, key: str | Sequence[str], order_desc: Sequence[str],
                  keep: Sequence[str] | None = None) -> DataFrame:
    """One row per ``key``: the row with the greatest ``order_desc`` tuple.

    ``order_desc`` is compared left to right (latest load first).  The row
    is picked as ``max(struct(order..., remaining kept columns...))``: the
    remaining columns break any tie left by ``order_desc``, so the pick is
    deterministic (a retried task picks the same row).
    """
    keys = [key] if isinstance(key, str) else list(key)
    keep = [c for c in (keep or df.columns) if c not in keys]
    fields = list(dict.fromkeys([*order_desc, *keep]))

    def pick(rows: DataFrame) -> DataFrame:
        picked = F.max(F.struct(*fields)).alias("_row")
        return rows.groupBy(*keys).agg(picked).select(*keys, *[F.col("_row." + c).alias(c) for c in keep])

    slot = F.pmod(F.xxhash64(*keys), F.lit(KEY_SLOTS))
    full = full_slots(df, slot)
    if not full:
        return pick(df.repartition(*keys))
    hot = slot.isin(full)
    return pick(df.where(~hot).repartition(*keys)).unionByName(pick(df.where(hot)))


def dedupe_in_rounds(df: DataFrame, key: str | Sequence[str], order_desc: Sequence[str], keep: Sequence[str] | None,
                     rounds: int, written: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """``dedupe_latest`` of a part of the keys at a time, so that only its shuffle is on disk.

    ``written(rows, k)`` writes the rows of part ``k`` and reads them back.  ``df`` is read in each of the rounds.
    """
    keys = [key] if isinstance(key, str) else list(key)
    part, out = F.pmod(F.xxhash64(*keys), F.lit(rounds)), None
    for k in range(rounds):
        rows = written(dedupe_latest(df if rounds == 1 else df.where(part == k), keys, order_desc, keep), k)
        out = rows if out is None else out.unionByName(rows)
    return out


#: Slots that keys are counted in; a slot is full with more rows than an average partition has and than a task sorts at ease.
KEY_SLOTS, FULL_ROWS = 4096, 1 << 18


def full_slots(df: DataFrame, slot) -> list[int]:
    """Slots with too many rows for one task (fewer than there are partitions); counts of all slots reach the driver."""
    from .skew import shuffle_partitions
    counts = {r[0]: r[1] for r in df.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1))).collect()}
    most = max(FULL_ROWS, sum(counts.values()) / shuffle_partitions(df))
    return sorted(s for s, n in counts.items() if n > most)


#: Paths of the tables between steps, where ``passing_tables`` deletes them.
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing_tables(spark):
    """Tables that the operators write between their steps go at its end: what was made of them must be written by then."""
    paths: list[str] = []
    token = _PASSING.set(paths)
    try:
        yield
    finally:
        _PASSING.reset(token)
        for path in paths:
            delete_file(spark, path)


def _written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back (several consumers read it)."""
    path = path or scratch_path(df.sparkSession, f"staging-{name}")
    if _PASSING.get() is not None:
        _PASSING.get().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def first_year_by(df: DataFrame, group: str | Sequence[str], date_col: str,
                  out: str = "release_year", salt_cols: Sequence[str] | None = None) -> DataFrame:
    """``df`` plus ``out`` = min(year(date_col)) over rows sharing ``group``.

    The per-group side is one aggregate (map-side partials) that also counts
    rows; it is written, as the join and the list of hot groups read it, and
    so that its size is known when the join is planned.  Groups larger than an
    average partition are joined back salted (``skew.salted_join``), so a hot
    title never lands in a single task.
    """
    from .skew import hot_keys, salted_join
    groups = [group] if isinstance(group, str) else list(group)
    per_group = _written(df.groupBy(*groups).agg(F.min(F.year(date_col)).cast("int").alias(out),
                                                 F.count(F.lit(1)).alias("_n")), "first-years")
    hot = hot_keys(per_group, groups, "_n")
    salt = list(salt_cols) if salt_cols else [c for c in df.columns if c not in groups]
    return salted_join(df, per_group.drop("_n"), groups, hot, salt)


def stg_revenues(raw: DataFrame) -> DataFrame:
    """Raw revenue rows -> staged rows.

    Input: id, revenue_date, title, revenue, theaters, distributor,
    _loaded_at (+ anything else, ignored).  Title whitespace is normalised,
    numbers are cast strictly (a bad value fails the job under ANSI mode),
    the latest load of every id wins, and ``release_year`` is the first year
    the normalised title earned revenue.
    """
    typed = raw.select(
        F.col("id"),
        F.col("revenue_date").cast("date").alias("revenue_date"),
        T.normalize_ws("title").alias("title"),
        T.strict_number("revenue", 12).alias("revenue"),
        T.strict_number("theaters", 6).alias("theaters"),
        F.col("distributor"),
        F.col("_loaded_at"),
    )
    # The rows are counted by key and then dealt: written once, so the joins and shuffles of ``raw`` are over by then.
    spark, path = typed.sparkSession, scratch_path(typed.sparkSession, "staging-typed")
    typed = _written(typed, "typed", path)
    # Latest load wins; payload columns break exact ties deterministically.
    # First year, group sizes and the join back all read these rows: written once.
    latest = dedupe_in_rounds(
        typed, "id",
        order_desc=["_loaded_at", "revenue_date", "revenue", "theaters", "title", "distributor"],
        keep=list(REVENUE_COLUMNS), rounds=rounds_of(folder_bytes(spark, path)),
        written=lambda rows, _: _written(rows, "latest"))
    delete_file(spark, path)
    staged = first_year_by(latest, "title", "revenue_date", salt_cols=["id"])
    return staged.select("id", "revenue_date", "title", "release_year",
                         "revenue", "theaters", "distributor")


def docs_table(envelopes: DataFrame, v: str = "v") -> DataFrame:
    """Columns derived from one VARIANT document per row (external-table view).

    lookup_title, lookup_year, status, imdb_id, response (whole document),
    _fetched_at.
    """
    return envelopes.select(
        J.vget(v, "$._lookup.title").alias("lookup_title"),
        J.vget(v, "$._lookup.year", "int").alias("lookup_year"),
        J.vget(v, "$._status").alias("status"),
        J.vget(v, "$.imdbID").alias("imdb_id"),
        F.col(v).alias("response"),
        F.to_timestamp_ntz(J.vget(v, "$._fetched_at")).alias("_fetched_at"),
    )


def ratings_score(docs: DataFrame, source: str = RATINGS_SOURCE, outer: bool = False) -> DataFrame:
    """Per imdb_id: max of the digits of ``Ratings[].Value`` where Source matches.

    Documents without a ``Ratings`` array produce no row (lateral flatten
    drops them); the caller left-joins, so those documents get NULL.
    ``outer=True`` keeps them as a row with a NULL score instead.
    """
    explode = F.explode_outer if outer else F.explode
    items = docs.select("imdb_id", explode(J.varray("response", "$.Ratings")).alias("r"))
    score = T.try_number(T.first_digits(J.vget("r", "$.Value")))
    return items.groupBy("imdb_id").agg(
        F.max(F.when(J.vget("r", "$.Source") == source, score)).alias("rotten_tomatoes_score"))


def _whole(c):
    return T.try_number(c)


def _digits(c):
    return T.try_number(T.first_digits(c))


#: Document layout: output column -> (field of the document, parser of its text or None).
DOC_LAYOUT = {
    "title": ("Title", None), "rated": ("Rated", None), "released_raw": ("Released", None),
    "runtime_min": ("Runtime", _digits), "genres": ("Genre", None), "director": ("Director", None),
    "writer": ("Writer", None), "actors": ("Actors", None), "plot": ("Plot", None),
    "languages": ("Language", None), "country": ("Country", None), "awards": ("Awards", None),
    "poster_url": ("Poster", None),
    "imdb_rating": ("imdbRating", lambda c: T.try_number(c, 4, 1)),
    "metascore": ("Metascore", _whole),
    "imdb_votes": ("imdbVotes", lambda c: T.try_number(F.replace(c, F.lit(","), F.lit("")))),
    "box_office_omdb": ("GrossRevenue", lambda c: T.try_number(T.strip_money(c))),
}


def own_score(doc: str = "response", source: str = RATINGS_SOURCE):
    """The score within one document: max of the digits of its ``Ratings`` from ``source``."""
    items = F.filter(J.varray(doc, "$.Ratings"), lambda r: J.vget(r, "$.Source") == source)
    return F.array_max(F.transform(items, lambda r: T.try_number(T.first_digits(J.vget(r, "$.Value")))))


def stg_docs(docs: DataFrame, layout: dict | None = None) -> DataFrame:
    """Found movie documents flattened to typed columns ('N/A' -> NULL).

    ``layout`` names the document's fields and their parsers (default
    ``DOC_LAYOUT``).  The documents are parsed and read once: the score of a
    document comes from its own ratings in the same projection, and the
    typed rows are written before the score per id is taken from them.
    """
    found = docs.where((F.col("status") == STATUS_FOUND)
                       & (J.vget("response", "$.Type") == TYPE_MOVIE))

    def column(name: str, field: str, parse):
        text = T.na_to_null(J.vget("response", "$." + field))
        return (parse(text) if parse else text).alias(name)

    flat = found.select("imdb_id", "lookup_title", "lookup_year",
                        *[column(n, f, p) for n, (f, p) in (layout or DOC_LAYOUT).items()],
                        "_fetched_at", own_score().alias("_own_score"))
    rows = _written(flat, "docs")
    score = rows.groupBy("imdb_id").agg(F.max("_own_score").alias("rotten_tomatoes_score"))
    from .skew import join_back
    joined = join_back(rows.drop("_own_score"), score, ["imdb_id"],
                       salt_cols=["lookup_title", "lookup_year", "_fetched_at"])
    return joined.select(*[c for c in flat.columns if c not in ("_fetched_at", "_own_score")],
                         "rotten_tomatoes_score", "_fetched_at")
