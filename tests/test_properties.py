"""Property: the chunk + halo plan equals the unsplit window plan for any
chunk size, bucket size and series shape."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import series as S
from tidemark.plans.partitioning import over_series


def build(d, s):
    return d.withColumns({
        "m3": S.rolling_mean("x", 3, s),
        "mx": S.rolling_prev(F.max, "x", 4, s),
        "l2": S.lag("x", s, 2),
        "f1": S.lead("x", s, 1),
        "pos": s.position(),
    })


@settings(max_examples=6, deadline=None)
@given(
    sizes=st.lists(st.integers(min_value=0, max_value=40), min_size=1, max_size=3),
    chunk=st.integers(min_value=1, max_value=9),
    bucket=st.sampled_from([1, 7, 3600]),
)
def test_chunked_equals_plain(spark, sizes, chunk, bucket):
    rows = []
    for k, n in enumerate(sizes):
        for i in range(n):
            rows.append((f"S{k}", dt.datetime(2026, 1, 1) + dt.timedelta(seconds=13 * i + k), float((i * 7919) % 101)))
    if not rows:
        return
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, x double")
    a = over_series(df, build, halo=4, lookahead=1, chunk_rows=chunk, bucket_size=bucket).withColumn("pos", F.col("pos").cast("long"))
    b = over_series(df, build, halo=4, lookahead=1, plain=True).withColumn("pos", F.col("pos").cast("long"))
    assert a.count() == b.count() == len(rows)
    assert a.exceptAll(b).count() == 0
