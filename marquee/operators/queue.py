"""Enrichment queue: which entities still need a lookup, in priority order.

queue = entities with revenue  ⟕̸ cached lookups  ⟕̸ lookups that failed today
ordered by lifetime revenue (NULLs last) and cut at min(requested, quota).

Both exclusions are ``left_anti`` joins - NULL keys never match, so
entities with a NULL key stay queued (the LEFT JOIN ... IS NULL meaning;
``NOT IN`` would drop everything as soon as one NULL appears).  The top-N is
``orderBy().limit(n)`` which Spark plans as TakeOrderedAndProject: every
partition keeps its own n best rows and only those n·P rows meet in one
task, never the whole queue.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T

# Daily API quota and the safety buffer kept unused, the
# default and allowed calls per run, the queue preview length.
DAILY_QUOTA = 1000
QUOTA_BUFFER = 50
DEFAULT_LIMIT = 25
MAX_LIMIT = 1000
PREVIEW_ROWS = 5


def entity_keys(revenues: DataFrame, key: str = "title", date_col: str = "revenue_date",
                amount: str = "revenue", normalize: bool = True) -> DataFrame:
    """Per entity: first year with revenue and lifetime revenue.

    The source view groups by the raw title; staging normalises it, so odd
    spellings would never join the cache.  ``normalize=True`` (default)
    groups by the normalised key, ``False`` keeps the raw one.
    """
    k = T.normalize_ws(key) if normalize else F.col(key)
    return (revenues.select(k.alias(key), date_col, amount)
            .groupBy(key)
            .agg(F.min(F.year(date_col)).cast("int").alias("release_year"),
                 F.sum(amount).alias("lifetime_rev")))


def errored_on(log: DataFrame, day: str, keys: Sequence[str], ts: str = "call_at",
               outcome: str = "outcome") -> DataFrame:
    """Distinct lookup keys whose call failed on ``day`` (range predicate on ts)."""
    return (log.where(F.col(outcome).startswith("error") & D.day_range(ts, day))
            .select(*keys).distinct())


def _anti(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    r = right.select(*[F.col(rc).alias(f"_r{i}") for i, (_, rc) in enumerate(on)])
    cond = None
    for i, (lc, _) in enumerate(on):
        c = left[lc] == r[f"_r{i}"]
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left_anti")


def fetch_queue(entities: DataFrame, cached: DataFrame, errored: DataFrame,
                on: Sequence[tuple[str, str]]) -> DataFrame:
    """Entities neither cached nor failed today; ``on`` pairs (entity col, lookup col)."""
    def keys(df: DataFrame) -> DataFrame:  # a hot key is one row of the join
        return df.select(*[c for _, c in on]).distinct()

    return _anti(_anti(entities, keys(cached), on), keys(errored), on)


def calls_on(log: DataFrame, day: str, ts: str = "call_at") -> DataFrame:
    return log.where(D.day_range(ts, day))


def quota(log: DataFrame, day: str, requested: int = DEFAULT_LIMIT, daily_quota: int = DAILY_QUOTA,
          buffer: int = QUOTA_BUFFER, ts: str = "call_at") -> DataFrame:
    """One row: calls made on ``day`` (any outcome), remaining quota, effective limit."""
    if not 0 <= requested <= MAX_LIMIT:
        raise ValueError(f"requested must be within 0..{MAX_LIMIT}")
    n = F.count(F.lit(1))
    remaining = F.greatest(F.lit(0), F.lit(daily_quota - buffer) - n)
    return calls_on(log, day, ts).agg(
        n.alias("calls_today"), remaining.alias("remaining"),
        F.least(F.lit(requested), remaining).alias("effective_limit"))


def effective_limit(log: DataFrame, day: str, requested: int = DEFAULT_LIMIT, **kw) -> int:
    """The run's cap as a driver scalar (one aggregated row, never the log)."""
    return int(quota(log, day, requested, **kw).select("effective_limit").first()[0])


def take(queue: DataFrame, n: int, key: Sequence[str] | str, by: str = "lifetime_rev") -> DataFrame:
    """Top ``n`` by ``by`` descending, NULLs last, ties by key; n <= 0 -> empty."""
    keys = [key] if isinstance(key, str) else list(key)
    ordered = queue.orderBy(F.desc_nulls_last(by), *[F.asc(k) for k in keys])
    return ordered.limit(max(0, int(n)))


def preview(queue: DataFrame, key, by: str = "lifetime_rev", rows: int = PREVIEW_ROWS) -> DataFrame:
    """Dry run: the first rows of the queue, no side effects."""
    return take(queue, rows, key, by)
