import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessella.operators import coverage as cov

KIND = "e string, id bigint, a double, b double, _shard string, kind string"


def brute(rows):
    seen = {}
    for e, i, a, b in rows:
        if i is None or a is None or b is None or a != a or b != b or abs(a) == float("inf") or abs(b) == float("inf"):
            continue
        x, y = int((a * 1000 + 0.5) // 1), int((b * 1000 + 0.5) // 1)
        if x < y:
            seen[(e, i, x, y)] = (x, y)
    out = set()
    for e in {k[0] for k in seen}:
        depth = {}
        for (k, _, _, _), (x, y) in seen.items():
            if k == e:
                for t in range(x, y):
                    depth[t] = depth.get(t, 0) + 1
        lo, hi = min(depth), max(depth) + 1
        for kind, test in (("period", lambda n: n >= 1), ("gap", lambda n: n == 0), ("overlap", lambda n: n >= 2)):
            t = lo
            while t < hi:
                if test(depth.get(t, 0)):
                    s = t
                    while t < hi and test(depth.get(t, 0)):
                        t += 1
                    out.add((e, kind, s, t))
                else:
                    t += 1
    return out


def run(spark, rows, shard=None, cut=None):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], KIND)
    old = cov.SHARD, cov.CUT
    cov.SHARD, cov.CUT = shard or cov.SHARD, cut or cov.CUT
    try:
        made = cov.coverage(df, ["e"], "id", "a", "b").collect()
        assert len(made) == len(set(made))
        return {tuple(r) for r in made}
    finally:
        cov.SHARD, cov.CUT = old


def test_small_cases(spark):
    rows = [("a", 1, 0.0, 1.0), ("a", 2, 0.5, 2.0), ("a", 2, 0.5, 2.0), ("a", 3, 3.0, 4.0), ("a", 4, 4.0, 5.0), ("a", 5, 6.0, 6.0), ("a", 6, 9.0, 7.0), ("a", 7, None, 1.0), ("a", None, 0.0, 9.0), (None, 8, 1.0, 2.0), ("b", 9, float("inf"), 3.0), ("b", 9, float("nan"), 3.0)]
    assert run(spark, rows) == brute([r for r in rows if r[0] is not None]) | {(None, "period", 1000, 2000)}


def test_touching_overlaps_are_one_and_touching_rows_are_none(spark):
    rows = [("a", 1, 0.0, 0.010), ("a", 2, 0.0, 0.005), ("a", 3, 0.005, 0.010), ("b", 4, 0.0, 0.005), ("b", 5, 0.005, 0.009)]
    got = run(spark, rows)
    assert ("a", "overlap", 0, 10) in got and not [r for r in got if r[0] == "b" and r[1] == "overlap"]


def test_empty(spark):
    assert run(spark, []) == set()


def test_runs_across_shards(spark):
    rows = [("a", 1, 0.0, 0.300), ("a", 2, 0.120, 0.130), ("a", 3, 0.119, 0.135), ("a", 4, -0.050, -0.020), ("a", 5, 1.0, 1.5)]
    for shard in (7, 64, 1000):
        assert run(spark, rows, shard) == brute(rows)


def test_hot_entity(spark):
    rng = random.Random(3)
    rows = [("hot", i, x / 1000, (x + rng.randrange(1, 9)) / 1000) for i, x in enumerate(rng.randrange(3000) for _ in range(4000))]
    assert run(spark, rows, 256) == brute(rows)


def test_very_long_rows(spark):
    far = 10**12
    rows = [("a", 1, 0.0, float(far)), ("a", 2, 5.0, 6.0), ("a", 3, float(far + 1), float(far + 2)), ("b", 4, -float(far), 1.0), ("b", 5, -1e9, 2e9), ("b", 5, -1e9, 2e9), ("c", 6, 1.0, 2.0)]
    ms = 1000
    assert run(spark, rows) == {
        ("a", "period", 0, far * ms), ("a", "overlap", 5000, 6000), ("a", "gap", far * ms, (far + 1) * ms), ("a", "period", (far + 1) * ms, (far + 2) * ms),
        ("b", "period", -far * ms, 2 * 10**9 * ms), ("b", "overlap", -(10**9) * ms, 1000), ("c", "period", 1000, 2000),
    }


def test_a_shard_that_spans_batches(spark):
    rows = [("hot", i % 3000, (i % 3000 * 37 % 9000) / 1000, (i % 3000 * 37 % 9000 + 1 + i % 7) / 1000) for i in range(5000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 30), st.integers(-20, 60), st.integers(-20, 60)), max_size=40), st.sampled_from([3, 5]))
def test_random_with_long_rows(spark, rows, shard):
    rows = [(e, i, x / 1000, y / 1000) for e, i, x, y in rows]
    assert run(spark, rows, shard, 2) == brute(rows)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 30), st.integers(-20, 60), st.integers(-20, 60)), max_size=40), st.sampled_from([5, 16, 1 << 16]))
def test_random(spark, rows, shard):
    rows = [(e, i, x / 1000, y / 1000) for e, i, x, y in rows]
    assert run(spark, rows, shard) == brute(rows)


def test_keys_of_any_name(spark):
    df = spark.createDataFrame([("a", "x", 1, 0.0, 1.0), ("a", "x", 2, 2.0, 3.0)], "id string, shard string, n bigint, lo double, hi double")
    assert {tuple(r) for r in cov.coverage(df, ["id", "shard"], "n", "lo", "hi").collect()} == {("a", "x", "period", 0, 1000), ("a", "x", "period", 2000, 3000), ("a", "x", "gap", 1000, 2000)}
