"""Load history: one record for each attempt to load a file.

A loader writes a file's rows to a folder of their own, then records the file
here; the record is the commit.  Whoever looks for pending files asks the
history, never the rows: a file without rows is known like any other, and the
cost does not grow with the table.  After a crash between rows and record the
file is still pending; loading it again rewrites the same folder.

Records are JSON lines below ``bucket=<n>`` by a checksum of the file's name, so
a lookup reads the buckets of the files asked for and no others.  ``compact``
joins the small files of a bucket.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import child_files, delete_file, move_to, path_exists, write_text

BUCKETS = 16
#: Files of a bucket from which on they are joined, so that a lookup's cost does not grow with the number of loads.
COMPACT_AT = 64
# The states of a load.
LOADED, FAILED = "LOADED", "FAILED"
RECORD_DDL = ("file string, size bigint, modified bigint, rows bigint, status string, error string, "
              "loader string, recorded_at string")
#: What identifies a delivery: the same name with other content is a new one.
IDENTITY = ("file", "size", "modified")


def bucket_of(file: str) -> int:
    return zlib.crc32(file.encode()) % BUCKETS


def bucket_column(file: str):
    return F.crc32(F.col(file).cast("binary")) % BUCKETS


class LoadHistory:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def record(self, entries: Sequence[dict], loader: str = "pickup") -> None:
        """Append records (file, size, modified, rows, status, error); one small file per bucket touched."""
        now = datetime.now(timezone.utc).isoformat()
        lines: dict[int, list[str]] = {}
        for e in entries:
            full = {"error": None, "rows": None, **e, "loader": loader, "recorded_at": now}
            lines.setdefault(bucket_of(e["file"]), []).append(json.dumps(full))
        for b, own in lines.items():
            folder = f"{self.root}/bucket={b}"
            write_text(self.spark, f"{folder}/{uuid.uuid4().hex}.json", "\n".join(own) + "\n")
            if len(child_files(self.spark, folder)) > COMPACT_AT:
                self._join(folder)

    def records(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """All records (of some buckets); none when nothing was loaded yet."""
        wanted = sorted({int(b) for b in (range(BUCKETS) if buckets is None else buckets)})
        folders = [f for f in (f"{self.root}/bucket={b}" for b in wanted) if path_exists(self.spark, f)]
        if not folders:
            return self.spark.createDataFrame([], f"{RECORD_DDL}, bucket int")
        rows = self.spark.read.schema(f"{RECORD_DDL}, bucket int").option("basePath", self.root).json(folders)
        return rows if buckets is None else rows.where(F.col("bucket").isin(wanted))

    def latest(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The last record of each delivery; a load that went well is not undone by a later failure."""
        rest = [c.strip().split(" ")[0] for c in RECORD_DDL.split(",") if c.strip().split(" ")[0] not in IDENTITY]
        order = F.struct((F.col("status") == LOADED).alias("good"), "recorded_at", *[c for c in rest if c != "recorded_at"])
        return (self.records(buckets).groupBy(*IDENTITY).agg(F.max(order).alias("_r"))
                    .select(*IDENTITY, *[F.col(f"_r.{c}").alias(c) for c in rest]))

    def pending(self, files: DataFrame, retry_failed: bool = False) -> DataFrame:
        """Those of ``files`` (with file, size, modified) that have no record; failed ones too with ``retry_failed``."""
        # At most ``BUCKETS`` numbers.
        asked = [r[0] for r in files.select(bucket_column("file")).distinct().collect()]
        known = self.latest(asked)
        if retry_failed:
            known = known.where(F.col("status") == LOADED)
        return files.join(known.select(*IDENTITY), list(IDENTITY), "left_anti")

    def compact(self) -> None:
        """One file per bucket."""
        for b in range(BUCKETS):
            folder = f"{self.root}/bucket={b}"
            if len(child_files(self.spark, folder)) > 1:
                self._join(folder)

    def _join(self, folder: str) -> None:
        """Join the files of a bucket.  The joined one is there before the old ones go, so a crash leaves records twice, never fewer."""
        old = child_files(self.spark, folder)
        joined = f"{self.root}/_joined-{uuid.uuid4().hex}"
        self.spark.read.text(old).coalesce(1).write.text(joined)
        for part in child_files(self.spark, joined):
            move_to(self.spark, part, f"{folder}/{uuid.uuid4().hex}.json")
        for path in (joined, *old):
            delete_file(self.spark, path)
