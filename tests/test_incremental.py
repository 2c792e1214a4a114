"""The incremental star equals a full rebuild after late rows, corrections and a stop half way."""
import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from marquee import session
from marquee.operators import marts, staging
from marquee.plans import incremental
from marquee.session import child_files, scratch_path

RAW = ("id string, revenue_date date, title string, revenue decimal(12,0), theaters decimal(6,0), distributor string, "
       "_loaded_at timestamp_ntz")


def documents(spark, n):
    """A document for each film and year of two, so a release year that moves finds another one."""
    docs = [(f"tt{i}{y}", f"T{i}", y) for i in range(n) for y in (2003, 2004) if i % 4]
    df = spark.createDataFrame(docs, "imdb_id string, lookup_title string, lookup_year int")
    text = ("title", "rated", "released_raw", "genres", "director", "writer", "actors", "plot", "languages", "country",
            "awards", "poster_url")
    numbers = ("runtime_min", "imdb_rating", "metascore", "imdb_votes", "box_office_omdb", "rotten_tomatoes_score")
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in text],
                     *[F.lit(None).cast("decimal(38,0)").alias(c) for c in numbers],
                     F.lit(None).cast("timestamp_ntz").alias("_fetched_at"))


def batches(spark, rows):
    day = lambda y, d: dt.date(y, 1, 1 + d)
    at = lambda n: dt.datetime(2024, 1, 1, 0, 0, n)
    rng = random.Random(rows)
    first = [(str(i), day(2004, rng.randrange(9)), f"T{i % 40}", i, 1, rng.choice(["A", "B", "C", None]), at(0))
             for i in range(rows)]
    late = [("900", day(2003, 2), "T1", 7, 1, "A", at(1)), ("901", day(2003, 2), "T2", 7, 1, "New", at(1))]
    fixed = [("900", day(2005, 2), "T1", 7, 1, "A", at(2)),                 # T1 goes back to its year
             ("41", day(2004, 1), "T7", 3, 1, "B", at(2)),                  # another title
             ("901", day(2003, 2), "  T2 ", 9, 2, "A", at(2)),              # the only row of a distributor
             ("3", day(2004, 1), "T3", 999, 1, "A", dt.datetime(2023, 1, 1))]  # older than what is there: no change
    plain = RAW.replace("decimal(12,0)", "int").replace("decimal(6,0)", "int")
    return [spark.createDataFrame(b, plain).withColumns({"revenue": F.col("revenue").cast("decimal(12,0)"),
                                                         "theaters": F.col("theaters").cast("decimal(6,0)")})
            for b in (first, late, fixed)]


def plain(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def same_as_rebuild(live, raw, docs):
    stg = staging.stg_revenues(raw)
    movies, dists = marts.dim_movie(stg, docs), marts.dim_distributor(stg)
    want = {"stg_revenues": stg, "dim_movie": movies, "dim_distributor": dists,
            "fact_daily_revenue": marts.fact_daily_revenue(stg, movies, dists)}
    now = live.tables()
    for name, df in want.items():
        assert plain(now[name].select(*df.columns)) == plain(df), name


def test_equals_a_rebuild_and_writes_touched_titles_only(spark):
    docs = documents(spark, 40)
    live = incremental.IncrementalStar(spark, scratch_path(spark, "t-inc"), docs, buckets=24)
    raw = None
    for k, batch in enumerate(batches(spark, 300)):
        raw = batch if raw is None else raw.unionByName(batch)
        before = live.fact.state()["parts"]
        files = {p: child_files(spark, live.fact._folder(p, v)) for p, v in before.items()}
        out = live.apply(batch)
        if k:
            assert out["titles"] <= 3 and all(len(p) <= 4 for p in out["rewritten"].values()), out
            now = live.fact.state()["parts"]
            assert all(child_files(spark, live.fact._folder(p, now[p])) == files[p]
                       for p in files if p not in out["rewritten"]["fact_daily_revenue"])
    same_as_rebuild(live, raw, docs)
    assert live.apply(raw.limit(0))["titles"] == 0
    assert live.apply(raw, number=0) == {"titles": 0, "rewritten": {}}  # done already


def test_a_batch_that_stopped_is_taken_up_again(spark, monkeypatch):
    docs = documents(spark, 40)
    live = incremental.IncrementalStar(spark, scratch_path(spark, "t-inc-stop"), docs, buckets=4)
    first, late, fixed = batches(spark, 120)
    live.apply(first)
    live.apply(late)
    for table in ("staged", "shares", "fact"):  # stopped before each of these merges
        with monkeypatch.context() as m:
            m.setattr(getattr(live, table), "merge", lambda *a, **b: (_ for _ in ()).throw(KeyboardInterrupt))
            with pytest.raises(KeyboardInterrupt):
                live.apply(fixed, number=2)
    assert live.apply(fixed, number=2)["titles"] == 3
    same_as_rebuild(live, first.unionByName(late).unionByName(fixed), docs)


def test_changed_documents_touch_their_titles(spark):
    docs = documents(spark, 40)
    live = incremental.IncrementalStar(spark, scratch_path(spark, "t-inc-docs"), docs.where("lookup_title <> 'T5'"), buckets=8)
    first = batches(spark, 120)[0]
    live.apply(first)
    live.docs = docs
    out = live.apply(first.limit(0), documents_of=spark.createDataFrame([("T5",)], "title string"))
    assert out["titles"] == 1
    same_as_rebuild(live, first, docs)


@pytest.mark.parametrize("round_bytes", [1, 64 << 20])
def test_only_the_current_star_stays_on_disk(spark, monkeypatch, round_bytes):
    """Old versions, what a batch wrote between its steps and tables of the operators go; in rounds or not, the star is the same."""
    monkeypatch.setattr(session, "ROUND_BYTES", round_bytes)
    docs = documents(spark, 40)
    root = session.checkpoint_root(spark)
    before = set(child_files(spark, root))
    live = incremental.fresh(spark, docs, buckets=3, keep_old=False)
    first, late, fixed = batches(spark, 120)
    live.apply(first)
    live.apply(late)
    with monkeypatch.context() as m:  # stopped before the last merge
        m.setattr(live.fact, "merge", lambda *a, **b: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            live.apply(fixed)
    assert live.apply(fixed, number=2)["titles"] == 3
    left = set(child_files(spark, root)) - before
    assert [f.rsplit("/", 1)[-1].rsplit("-", 1)[0] for f in left] == ["incremental"], left
    same_as_rebuild(live, first.unionByName(late).unionByName(fixed), docs)
    for table in (live.latest, live.staged, live.movies, live.shares, live.distributors, live.fact):
        held = [p for v in child_files(spark, f"{table.root}/data") for p in child_files(spark, v) if "/_part=" in p]
        assert len(held) == len(table.state()["parts"]), held
    assert child_files(spark, f"{live.root}/_work") == []


def test_old_versions_stay_for_readers_unless_told(spark):
    docs = documents(spark, 40)
    live = incremental.IncrementalStar(spark, session.scratch_path(spark, "t-inc-old"), docs, buckets=3)
    first, late, _ = batches(spark, 120)
    live.apply(first)
    read = live.tables()["fact_daily_revenue"]
    n = read.count()
    live.apply(late)
    assert read.count() == n


def test_staging_passes_its_tables_on_and_frees_its_shuffles(spark, monkeypatch):
    raw = batches(spark, 300)[0].unionByName(batches(spark, 120)[0])
    want = plain(staging.stg_revenues(raw))
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffles():
        return {f for d in dirs for _, _, fs in os.walk(d) for f in fs if f.startswith("shuffle_") and f.endswith(".data")}

    monkeypatch.setattr(session, "ROUND_BYTES", 1)
    root, had = session.checkpoint_root(spark), shuffles()
    before = set(child_files(spark, root))
    out = session.scratch_path(spark, "t-staged")
    with session.shuffles_freed(spark):
        with staging.passing_tables(spark):
            staging.stg_revenues(raw).write.parquet(out)
        until = time.time() + 30
        while shuffles() - had and time.time() < until:
            time.sleep(0.2)
    assert not shuffles() - had
    assert spark.conf.get(session.FREE_SHUFFLES, None) is None
    assert [f.rsplit("/", 1)[-1] for f in set(child_files(spark, root)) - before] == [out.rsplit("/", 1)[-1]]
    assert plain(spark.read.parquet(out)) == want
