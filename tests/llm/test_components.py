"""Connected components: from links that come out otherwise each time they are computed, too."""
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from marquee.llm.graph import components


def test_links_are_evaluated_once(spark):
    def either(batches):
        """One of two links between equal ends, drawn anew whenever the rows are computed."""
        import os

        for b in batches:
            x = np.asarray(b.column(0))
            swap = np.frombuffer(os.urandom(len(x)), np.uint8) < 128
            yield pa.record_batch([pa.array(np.where(swap, x + 1, x)), pa.array(np.where(swap, x, x + 1))], names=["a", "b"])

    ends = spark.range(0, 4000, 4).select(F.explode(F.sequence("id", F.col("id") + 2)).alias("x"))
    got = {r["node"]: r["component"] for r in components(ends.mapInArrow(either, "a long, b long")).collect()}
    assert got == {i: i - i % 4 for i in range(4000)}


def test_chains_stars_and_loops(spark):
    rows = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
