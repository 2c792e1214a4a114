"""Session construction and the shared scratch location.

Scale notes
-----------
* AQE is on: shuffle partitions are coalesced at runtime, a sort-merge join
  whose build side turns out small after its shuffle is switched to a
  broadcast join (a size bound that is *measured*, not assumed), and skewed
  join partitions (a hot title / distributor holding a third of the rows)
  are split.
* ``spark.checkpoint.dir`` names the shared folder of the cluster.  Every
  file this library writes between steps (round trips, stream checkpoints,
  cut lineage) goes below it.  A folder of our own is created only when the
  session has none, which is the case in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on; a cluster session may already carry them.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Variant and JSON keys are case-sensitive; struct fields must be too.
    "spark.sql.caseSensitive": "true",
}


def build_session(master: str | None = None, partitions: int = 8,
                  app: str = "marquee") -> SparkSession:
    """Local/test session.  On a cluster use the session you are given."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.shuffle.partitions", str(partitions))
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.driver.memory", os.environ.get("MARQUEE_DRIVER_MEM", "8g")))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    for k, v in SCALE_CONF.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from ``spark.checkpoint.dir`` (or a folder set on the context).  A
    temporary folder of our own serves only in ``local[...]`` sessions, whose
    one process is driver and executor alike; on a cluster without the
    setting this raises, since executors could not read the driver's disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="marquee-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, asked of its own file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _at(spark: SparkSession, path: str):
    """(file system, path) of a path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def child_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of what lies in a folder (none if it is not there), without the writers' own marks."""
    fs, at = _at(spark, folder)
    if not fs.exists(at):
        return []
    names = [s.getPath().toString() for s in fs.listStatus(at)]
    return sorted(n for n in names if n.rsplit("/", 1)[-1] != "_SUCCESS" and not n.endswith(".crc"))


def delete_file(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all that is in it."""
    fs, at = _at(spark, path)
    fs.delete(at, True)


def move_to(spark: SparkSession, path: str, target: str) -> str:
    """Move a file to ``target`` (its folder is made if needed); returns where it is now.

    A target that is there already is never overwritten: the file gets the
    next free number before its suffix.
    """
    fs, at = _at(spark, path)
    _, to = _at(spark, target)
    fs.mkdirs(to.getParent())
    folder, name = target.rsplit("/", 1)
    stem, dot, suffix = name.partition(".")
    n = 1
    while fs.exists(to):
        n += 1
        _, to = _at(spark, f"{folder}/{stem}-{n}{dot}{suffix}")
    if not fs.rename(at, to):
        raise OSError(f"could not move {path} to {target}")
    return to.toString()


def below(spark: SparkSession, folder: str, path: str) -> str:
    """The part of ``path`` below ``folder`` (its name alone if it lies elsewhere)."""
    fs, at = _at(spark, folder)
    root, whole = at.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri().getPath(), _at(spark, path)[1].toUri().getPath()
    root = root.rstrip("/") + "/"
    return whole[len(root):] if whole.startswith(root) else whole.rsplit("/", 1)[-1]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text, read on the driver."""
    fs, at = _at(spark, path)
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def commit_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not be there yet; it appears whole or not at all."""
    fs, at = _at(spark, path)
    _, new = _at(spark, f"{path}.{uuid.uuid4().hex[:8]}.new")
    out = fs.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(at) or not fs.rename(new, at):
        fs.delete(new, False)
        raise RuntimeError(f"another writer has committed {path}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file: written beside it, then renamed over it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at, new = hadoop.Path(path), hadoop.Path(path + ".new")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(at, False)
    if not fs.rename(new, at):
        raise OSError(f"could not write {path}")


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder (0 if it is not there)."""
    fs, at = _at(spark, path)
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Within it a query's shuffle files go when the query ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


#: What is dealt anew in rounds is so many bytes of files a round, in so many rounds at most; a round reads all that was written before it.
ROUND_BYTES, MOST_ROUNDS = 64 << 20, 8


def rounds_of(size: int) -> int:
    """Rounds in which ``size`` bytes of files are dealt anew, so that only a part's shuffle is on disk at a time."""
    return max(1, min(MOST_ROUNDS, -(-size // ROUND_BYTES)))


def app_id(spark: SparkSession) -> str:
    """The application id (works with and without a local SparkContext)."""
    try:
        return spark.conf.get("spark.app.id")
    except Exception:  # pragma: no cover
        return spark.sparkContext.applicationId


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
