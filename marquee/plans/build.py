"""The star build: staging written once, marts written once, reports read them.

Like the warehouse models (staging feeding four mart tables that the
reporting layer imports), the build materialises ``stg_revenues`` - it has
four consumers (documents, two dimensions, fact) - and then the marts,
into the cluster's shared checkpoint folder.  Reports, checks and measures
scan those tables instead of re-running de-duplication per consumer, and a
lost executor costs a re-read of files rather than a rebuild of the star.

One build is kept per (application, input folder) while the input files stay
as they are; changed files, a new folder or a new application build again.
"""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..functions import dates as D
from ..operators import marts, staging
from ..session import app_id, scratch_path, shuffles_freed
from ..sources.tables import table_path
from . import standins as S

_BUILDS: dict[tuple[str, str], tuple[tuple, dict[str, DataFrame]]] = {}
_LOCK = threading.Lock()


def build_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Materialised stg_revenues, stg_docs and the four marts (read back from files)."""
    root = scratch_path(spark, "star")

    def write(name: str, df: DataFrame) -> DataFrame:
        return marts.materialize(spark, {name: df}, root)[name]

    # Each step reads the files of the step before, never its lazy plan.
    # Steps that do not depend on each other are submitted together, so the
    # executors stay busy while one job finishes its last tasks.
    with staging.passing_tables(spark):
        stg = write("stg_revenues", S.stg(spark, sf_dir))
    with staging.passing_tables(spark), ThreadPoolExecutor(max_workers=3) as pool:
        f_docs = pool.submit(write, "stg_docs", staging.stg_docs(S.docs(spark, sf_dir, stg)))
        f_cal = pool.submit(write, "dim_date",
                            marts.dim_date_from(D.year_padded_bounds(stg, "revenue_date")))
        f_dist = pool.submit(write, "dim_distributor", marts.dim_distributor(stg))
        docs, calendar, dists = f_docs.result(), f_cal.result(), f_dist.result()
    movies = write("dim_movie", marts.dim_movie(stg, docs))
    fact = write("fact_daily_revenue", marts.fact_daily_revenue(stg, movies, dists))
    return {"stg_revenues": stg, "stg_docs": docs, "dim_date": calendar, "dim_movie": movies,
            "dim_distributor": dists, "fact_daily_revenue": fact}


#: Tables that the star is made from.
INPUTS = ("lineitem", "part", "supplier")


def input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the input files; a changed input is another state."""
    hadoop, out = spark._jvm.org.apache.hadoop.fs, []
    for name in INPUTS:
        path = hadoop.Path(table_path(sf_dir, name))
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files = fs.listFiles(path, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The build of ``sf_dir`` as it is now (made on first use in this application)."""
    key = (app_id(spark), sf_dir.rstrip("/"))
    state = input_state(spark, sf_dir)
    with _LOCK:
        if _BUILDS.get(key, (None,))[0] != state:
            with shuffles_freed(spark):
                _BUILDS[key] = (state, build_star(spark, sf_dir))
        return _BUILDS[key][1]
