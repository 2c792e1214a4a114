"""The document cache as a table whose listing is frozen until it is refreshed.

``refresh`` registers the files that lie in the day folders of the cache now, in
a table of files partitioned by day: only days with new or vanished files are
written anew.  ``read`` reads the registered files and no others, so a document
written since is not seen, and a day that a keyed write has replaced is read as
it was (``write_documents`` with a key keeps replaced files below
``_superseded`` until the next refresh).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json as J
from ..session import below, child_files, delete_file, path_exists
from .json_docs import DAY_COLUMNS, SUPERSEDED
from .keyed_table import KeyedTable

LISTING = "file string, day int, size bigint, modified bigint, gone boolean, seen bigint"


def _day_of(file: str) -> Column:
    """The day (yyyymmdd) of a file's path below the cache."""
    return F.regexp_replace(F.regexp_extract(file, r"yyyy=\d+/mm=\d+/dd=\d+", 0), r"\D", "").cast("int")


class FrozenDocuments:
    """The cache at ``docs_root`` as registered in ``listing_root`` (by default beside it)."""

    def __init__(self, spark: SparkSession, docs_root: str, listing_root: str | None = None):
        self.spark, self.root = spark, docs_root.rstrip("/")
        # The day is part of a file's path, so a partition of the day is one of the key.
        self.listing = KeyedTable(spark, listing_root or f"{self.root}_listing", LISTING, "file", ["seen"],
                                  partition=_day_of("file"), gone="gone")

    def _present(self) -> DataFrame:
        """Files that lie in the day folders now (a listing, no document is read)."""
        if not path_exists(self.spark, self.root):
            return self.spark.createDataFrame([], "file string, size bigint, modified bigint")
        names = (self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.root)
                     .select("path", F.col("length").alias("size"), F.unix_millis("modificationTime").alias("modified")))
        # The path below the cache's root, from its first day folder on.
        file = F.regexp_extract("path", r"yyyy=\d+/mm=\d+/dd=\d+/[^/]+$", 0)
        return names.select(file.alias("file"), "size", "modified").where("file <> ''")

    def refresh(self) -> dict:
        """Register what is there now; returns {"added", "removed", "days"} (days whose part of the listing changed)."""
        now, held = self._present(), self.listing.read()
        same = ["file", "size", "modified"]
        new = now.join(held.select(*same), same, "left_anti").withColumns({"day": _day_of("file"), "gone": F.lit(False)})
        lost = held.join(now.select("file"), "file", "left_anti").withColumn("gone", F.lit(True))
        seen = F.lit(self.listing.state()["version"] + 1).cast("long")
        change = new.unionByName(lost.select(*new.columns)).withColumn("seen", seen)
        counts = {r["gone"]: r["n"] for r in change.groupBy("gone").agg(F.count(F.lit(1)).alias("n")).collect()}
        days = self.listing.merge(change)["rewritten"] if counts else []
        delete_file(self.spark, f"{self.root}/{SUPERSEDED}")
        return {"added": counts.get(False, 0), "removed": counts.get(True, 0), "days": days}

    def files(self, days: Sequence[str] | None = None) -> list[str]:
        """Registered files of some days (``yyyymmdd``), where they lie now; as many names as the engine lists for a scan."""
        wanted = None if days is None else [str(int(d)) for d in days]
        names = [r[0] for r in self.listing.read(wanted).select("file").collect()]
        kept = f"{self.root}/{SUPERSEDED}"
        moved = set()
        if path_exists(self.spark, kept):
            tree = [kept]
            for _ in (*DAY_COLUMNS, "file"):
                tree = [c for t in tree for c in child_files(self.spark, t)]
            moved = {below(self.spark, kept, f) for f in tree}
        return sorted(f"{kept}/{n}" if n in moved else f"{self.root}/{n}" for n in names)

    def read(self, days: Sequence[str] | None = None, whole_file: bool = False) -> DataFrame:
        """Registered documents: VARIANT column ``v`` and the day columns (see ``json_docs.read_documents``)."""
        files, kept = self.files(days), f"{self.root}/{SUPERSEDED}"
        out = None
        for base in (self.root, kept):
            own = [f for f in files if f.startswith(kept + "/") == (base == kept)]
            if own:
                text = self.spark.read.option("basePath", base).text(own, wholetext=whole_file)
                one = text.select(J.parse("value").alias("v"), *DAY_COLUMNS)
                out = one if out is None else out.unionByName(one)
        if out is None:
            out = self.spark.range(0).select(J.parse(F.lit("{}")).alias("v"), *[F.lit(0).alias(c) for c in DAY_COLUMNS])
        return out
