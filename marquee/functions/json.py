"""Semi-structured helpers over VARIANT / JSON text.

Documents are parsed once into a VARIANT column; field lookups are
``try_variant_get`` (case-sensitive keys, NULL when missing or of another
type), so a document without ``Type`` – or with ``type`` in lower case –
never matches ``Type = 'movie'``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of


def parse(c: Column | str) -> Column:
    """JSON text -> VARIANT; malformed text becomes NULL instead of failing."""
    return F.try_parse_json(col_of(c))


def vget(v: Column | str, path: str, typ: str = "string") -> Column:
    """``v:path::typ``; NULL when the path is missing or cannot be cast."""
    return F.try_variant_get(col_of(v), path, typ)


def varray(v: Column | str, path: str) -> Column:
    """The array at ``path`` as ``array<variant>`` (NULL when absent / not an array)."""
    return F.try_variant_get(col_of(v), path, "array<variant>")


def merge_objects(base_json: Column | str, override_json: Column | str) -> Column:
    """Merge two JSON objects; keys of ``override_json`` win on a clash.

    Both sides are read as ``map<string, variant>`` so nested arrays and
    objects are kept as JSON, not flattened to text.  Clashing keys are
    removed from the base before ``map_concat``, so no map-key de-dup
    policy is needed.
    """
    base = F.from_json(col_of(base_json), "map<string,variant>")
    over = F.from_json(col_of(override_json), "map<string,variant>")
    kept = F.map_filter(base, lambda k, _v: ~F.array_contains(F.map_keys(over), k))
    return F.to_json(F.map_concat(kept, over))


# Timestamps travel with microseconds (the default JSON format keeps millis).
TS_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
              "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def pack_json_array(*cols: Column | str) -> Column:
    """Aggregate: the group's rows as one JSON array of objects."""
    return F.to_json(F.collect_list(F.struct(*[col_of(c) for c in cols])), TS_OPTIONS)


def unpack_json_array(c: Column | str, element_ddl: str) -> Column:
    """JSON array text -> array<struct<...>> (``inline`` it to get rows)."""
    return F.from_json(col_of(c), f"array<struct<{element_ddl}>>", TS_OPTIONS)
