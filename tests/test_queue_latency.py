import datetime as dt
import random

from pyspark.sql import functions as F

from marquee.operators import latency, queue as Q

from core_rows import rows

AS_OF = "2024-01-30"


def _log(spark, data):
    return spark.createDataFrame(data, "lookup_key string, call_at timestamp_ntz, outcome string")


def test_queue_excludes_cached_and_errored_today(spark):
    ents = spark.createDataFrame(
        [("A", 2003, 10.0), ("B", 2003, 30.0), ("C", 2003, None), ("D", 2003, 20.0), (None, 2003, 5.0)],
        "title string, release_year int, lifetime_rev double")
    cached = spark.createDataFrame([("B", 2003), (None, 2003)], "lookup_title string, lookup_year int")
    log = spark.createDataFrame(
        [("A", 2003, dt.datetime(2024, 1, 30, 9), "error_5xx"),      # error today -> out
         ("D", 2003, dt.datetime(2024, 1, 29, 23), "error_429"),     # yesterday -> stays
         ("C", 2003, dt.datetime(2024, 1, 30, 9), "found")],         # not an error
        "lookup_title string, lookup_year int, call_at timestamp_ntz, outcome string")
    err = Q.errored_on(log, AS_OF, ["lookup_title", "lookup_year"])
    on = [("title", "lookup_title"), ("release_year", "lookup_year")]
    q = Q.fetch_queue(ents, cached, err, on)
    # NULL key never matches the NULL cached key, so it stays queued.
    assert [r.title for r in Q.take(q, 10, "title").collect()] == ["D", None, "C"]
    assert [r.title for r in Q.take(q, 1, "title").collect()] == ["D"]
    assert Q.take(q, 0, "title").count() == 0


def test_quota(spark):
    day = dt.datetime(2024, 1, 30, 10)
    log = _log(spark, [("k", day, "found")] * 960 + [("k", dt.datetime(2024, 1, 29, 10), "found")] * 5)
    r = Q.quota(log, AS_OF, 25).first()
    assert (r.calls_today, r.remaining, r.effective_limit) == (960, 0, 0)
    log2 = _log(spark, [("k", day, "error_other")] * 940)
    assert Q.effective_limit(log2, AS_OF, 25) == 10
    assert Q.effective_limit(_log(spark, [("k", day, "found")]).limit(0), AS_OF, 25) == 25


def test_entity_keys_normalise(spark):
    rev = spark.createDataFrame([(" A  B", dt.date(2004, 1, 1), 5), ("A B", dt.date(2003, 1, 1), 7)],
                                "title string, revenue_date date, revenue int")
    assert rows(Q.entity_keys(rev)) == [("A B", 2003, 12)]
    assert len(rows(Q.entity_keys(rev, normalize=False))) == 2


def _brute(samples):
    out = {}
    for step in sorted({s for s, _ in samples}):
        v = sorted(x for s, x in samples if s == step)
        n = len(v)
        out[step] = (n, v[n // 2] * 1000, v[min(int(n * 0.95), n - 1)] * 1000, v[-1] * 1000)
    return out


def test_step_profile_exact(spark):
    rnd = random.Random(7)
    samples = ([("api", round(rnd.expovariate(2), 3)) for _ in range(5001)]
               + [("s3", float(rnd.randint(1, 5))) for _ in range(3000)]        # heavy ties
               + [("log", 0.25)] * 7 + [("total", rnd.random()) for _ in range(2)])
    df = spark.createDataFrame(samples, "step string, value double")
    got = {r.step: r for r in latency.step_profile(df, accuracy=500).collect()}
    want = _brute(samples)
    for step, (n, p50, p95, mx) in want.items():
        r = got[step]
        assert (r.n, r.p50_ms, r.p95_ms, r.max_ms) == (n, p50, p95, mx), step
    denom = sum(x for s, x in samples if s in ("api", "s3", "log"))
    api_total = sum(x for s, x in samples if s == "api")
    assert abs(got["api"].pct - round(api_total / denom * 100, 3)) < 1e-9
    assert got["total"].pct == 100.0
