"""License scans: MinHash bands over overlapping windows, then exact containment.

A text is its words (A-Z lower-cased, ASCII other than letters and digits
apart) and their five-word shingles.  Windows of 1, 4 and 16 shingles overlap
at strides of 1, 2 and 8; each gives 1, 2 or 4 bands of one MinHash row (the
least shingle hash under a permutation of its own).  A template of T shingles
takes the widest window of w shingles and stride s with T >= w + s - 1 and
puts its own windows at every offset into the index, so wherever it stands in
a text some window of the text equals one of its windows and all bands agree.
Where a fifth of its shingles are changed, a 16-shingle window that keeps 13
still meets its counterpart in one of four bands with odds of 0.99, and there
are several windows.  Retrieved templates are verified by the exact share of
their shingles that the text contains.

Everything is array expressions of the engine: no Python, and no shuffle but
the last small aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

WIDTH = 5
#: Shingles of a window, stride, and bands, from the widest.
WINDOWS = ((16, 8, 4), (4, 2, 2), (1, 1, 1))
#: Bounds the index that goes with every task as a literal; more templates are searched for in several passes.
MAX_KEYS = 50_000

# Names and texts of public licence notices.
TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions"),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies."),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"),
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version."),
}

#: ASCII other than letters and digits.
APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it.

    (A column would not do: the optimizer may put its definition in place of
    its name, also inside of lambdas, where it would be computed again for
    each element.)
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), APART), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(words: Column) -> Column:
    """Hashes of all shingles in text order (none under five words)."""
    last = F.size(words) - WIDTH
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.expr("array()").cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WIDTH)]))


def _permutation(width: int, band: int) -> int:
    """Constant of a band's permutation (xor); one for each window width and band."""
    x = (width * 64 + band + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    return x - (1 << 64) if x >= 1 << 63 else x


def band_keys(shingles: Column, width: int, stride: int, bands: int) -> Column:
    """MinHash of every band of the windows of ``width`` shingles, all windows of a band in turn."""
    starts = F.when(F.size(shingles) >= width,
                    F.sequence(F.lit(1), F.size(shingles) - (width - 1), F.lit(stride))) \
        .otherwise(F.expr("array()").cast("array<int>"))
    out = []
    for band in range(bands):
        mask = F.lit(_permutation(width, band))
        least = lambda i: F.array_min(F.transform(F.slice(shingles, i, width),
                                                  lambda h: h.bitwiseXOR(mask)))  # noqa: B023
        out.append(shingles if width == 1 else F.transform(starts, least))
    return F.concat(*out) if len(out) > 1 else out[0]


@dataclass(frozen=True)
class Index:
    """Band keys of the templates, and each template's shingles; bounded by ``MAX_KEYS``."""

    keys: dict[int, list[str]]
    shingles: dict[str, list[int]]

    @classmethod
    def build(cls, spark, templates: dict[str, str]) -> "Index":
        """From (name, text); a template under five words cannot be scanned for."""
        table = spark.createDataFrame(sorted(templates.items()), "name string, body string")
        made = let(word_hashes(F.col("body")), lambda w: let(shingle_hashes(w), lambda s: F.struct(
            s.alias("s"), *[band_keys(s, width, 1, bands).alias(f"k{width}") for width, _, bands in WINDOWS])))
        table = table.select("name", made.alias("m")).select("name", "m.*")
        keys: dict[int, list[str]] = {}
        shingles = {}
        for row in table.collect():
            n = len(row["s"])
            if not n:
                raise ValueError(f"template {row['name']} has fewer than {WIDTH} words")
            shingles[row["name"]] = sorted(set(row["s"]))
            width = next(w for w, s, _ in WINDOWS if n >= w + s - 1)
            for k in set(row[f"k{width}"]):
                keys.setdefault(k, []).append(row["name"])
        return cls(keys, shingles)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, percent: int = 80,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and licence notice that it contains.

    Columns: doc_id, license, n_shared and n_template (distinct shingles; at
    least ``percent`` of the template's are shared), first_word (where in the
    document's words, from 0, the first shared shingle begins).

    Defined cases: null, empty and very short texts contain nothing; rows that
    repeat an id are one document of which the best row counts; rows with a
    null id are taken together; an empty table gives no rows; further columns
    are ignored.
    """
    out = None
    for index in _indexes(docs.sparkSession, TEMPLATES if templates is None else templates):
        found = _scan(docs, index, percent, id_col, text_col)
        out = found if out is None else out.unionByName(found)
    return out


def _indexes(spark, templates: dict[str, str]) -> list[Index]:
    """Indexes of at most ``MAX_KEYS`` keys that hold all templates (a larger template has one of its own)."""
    index = Index.build(spark, templates)
    if len(index.keys) <= MAX_KEYS or len(templates) < 2:
        return [index]
    names = sorted(templates)
    half = len(names) // 2
    return [i for part in (names[:half], names[half:]) for i in _indexes(spark, {n: templates[n] for n in part})]


def _scan(docs: DataFrame, index: Index, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The notices of one index; those of different templates do not depend on each other."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    known = F.lit(sorted(index.keys)) if index.keys else F.expr("array()").cast("array<bigint>")
    made = let(word_hashes(F.col("_text")), lambda w: let(shingle_hashes(w), lambda s: F.struct(
        s.alias("s"), F.array_intersect(F.concat(*[band_keys(s, *x) for x in WINDOWS]), known).alias("hits"))))
    # The row number keeps filters on the result from being computed a second
    # time below it (they do not pass a projection that is not deterministic).
    hits = rows.select("doc_id", made.alias("_m"), F.monotonically_increasing_id().alias("_row")) \
        .filter("_row >= 0").select("doc_id", F.col("_m.s").alias("_s"), F.col("_m.hits").alias("_hits"))
    by_key = spark.createDataFrame(
        [(k, n, index.shingles[n]) for k, names in index.keys.items() for n in names],
        "_key long, license string, _template array<bigint>")
    # The table of keys is bounded by MAX_KEYS (or by one template).
    found = hits.select("doc_id", "_s", F.explode("_hits").alias("_key")).join(F.broadcast(by_key), "_key")
    shared = F.array_intersect("_s", "_template")
    exact = found.withColumn("_shared", shared).filter(100 * F.size("_shared") >= percent * F.size("_template"))
    # array_intersect keeps the order of the text, so its first element stands first.
    return exact.groupBy("doc_id", "license").agg(
        F.max(F.size("_shared")).cast("long").alias("n_shared"),
        F.max(F.size("_template")).cast("long").alias("n_template"),
        F.min(F.array_position("_s", F.get("_shared", F.lit(0))) - 1).cast("long").alias("first_word"))
