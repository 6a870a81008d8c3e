"""Property tests on random inputs (few examples: each runs Spark jobs)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from logwise.operators import accumulate, count_by, total_snapshots
from conftest import rows

KEYS = st.sampled_from(["a", "b", "c", "狗"])
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(KEYS, st.integers(0, 3)), max_size=30), st.lists(st.tuples(KEYS, st.integers(0, 3)), max_size=30))
def test_accumulate_equals_counting_everything(spark, base_rows, delta_rows):
    schema = "word string, date int"
    base = count_by(spark.createDataFrame(base_rows, schema), "word", "date", name="count")
    delta = count_by(spark.createDataFrame(delta_rows, schema), "word", "date", name="count")
    both = spark.createDataFrame(base_rows + delta_rows, schema)
    assert rows(accumulate(base, delta)) == rows(count_by(both, "word", "date", name="count"))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 12), KEYS), min_size=1, max_size=40), st.sampled_from([2, 3, 4096]))
def test_snapshots_equal_running_totals(spark, data, block):
    df = spark.createDataFrame(data, "batch int, k string")
    got = {(r.batch, r.k): r.total for r in total_snapshots(df, "k", "batch", block=block).collect()}
    last = max(b for b, _ in data)
    want = {}
    for k in {k for _, k in data}:
        first = min(b for b, kk in data if kk == k)
        for b in range(first, last + 1):
            want[(b, k)] = sum(1 for bb, kk in data if kk == k and bb <= b)
    assert got == want
