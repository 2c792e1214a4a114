"""Surrogate and record keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of

# Record id prefix for documents without a natural id, the
# number of hex digits kept, the separator between title and year, and the
# object path layout of the JSON cache.
NOT_FOUND_PREFIX = "notfound_"
HASH_HEX_DIGITS = 12
LOOKUP_SEPARATOR = "|"
DOC_PATH_ROOT = "raw/omdb"


def md5_key(c: Column | str) -> Column:
    """Hex MD5 of the natural key (distributor name)."""
    return F.md5(col_of(c))


def lookup_hash(title: Column | str, year: Column | str) -> Column:
    """First 12 hex digits of SHA-1 over 'title|year'."""
    return F.substring(
        F.sha1(F.concat(col_of(title), F.lit(LOOKUP_SEPARATOR), col_of(year).cast("string"))),
        1, HASH_HEX_DIGITS)


def record_id(natural_id: Column | str, title: Column | str, year: Column | str) -> Column:
    """Natural id when present, else 'notfound_' + hash of the lookup."""
    return F.coalesce(col_of(natural_id),
                      F.concat(F.lit(NOT_FOUND_PREFIX), lookup_hash(title, year)))


def doc_object_path(fetched_at: Column | str, rid: Column | str) -> Column:
    """'raw/omdb/yyyy=YYYY/mm=MM/dd=DD/<record id>.json' for the fetch day."""
    t = col_of(fetched_at)
    return F.concat(
        F.lit(DOC_PATH_ROOT + "/yyyy="), F.date_format(t, "yyyy"),
        F.lit("/mm="), F.date_format(t, "MM"),
        F.lit("/dd="), F.date_format(t, "dd"),
        F.lit("/"), col_of(rid), F.lit(".json"))
