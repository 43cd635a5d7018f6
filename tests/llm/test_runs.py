import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.llm import runs as rn

KIND = "dataset string, stem string, token_id bigint, word string, start_s double, end_s double, shard int, key string"


def found(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], KIND)
    return {(r.first_id, r.last_id, r.n) for r in rn.event_runs(df, **kw).collect()}


def seq(words, stem="u", step=1.0):
    return [("d", stem, i, w, i * step, i * step + 0.5) for i, w in enumerate(words)]


def test_keys(spark):
    given_ = ["UHMMM", "uhm", "<|Uhm|>", "ＵＨＭ", "question_EN", "[Question-en] ", "de5", "de55", "ma1", "ma2", "", "[ ]", None, "aab", "ab", "é", "e"]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given_)], "i int, w string")
    keys = [r.k for r in df.select("i", rn.alike_key(F.col("w")).alias("k")).orderBy("i").collect()]
    assert keys == ["uhm"] * 4 + ["questionen"] * 2 + ["de5", "de55", "ma1", "ma2", None, None, None, "ab", "ab", "é", "e"]


def test_runs(spark):
    assert found(spark, seq(["a", "A", "b", "b ", "[B]", "c", None, None, "", ""])) == {(0, 1, 2), (2, 4, 3)}


def test_order_repeats_and_gaps(spark):
    rows = [("d", "u", 9, "x", 2.0, None), ("d", "u", 4, "X", 1.0, 1.5), ("d", "u", 4, "X", 1.0, 1.5), ("d", "u", 7, "y", 3.0, 3.1), ("d", "v", 8, "x", 0.0, 1.0), ("d", "u", None, "y", 4.0, 5.0), ("d", "u", 11, "y", None, 5.0), ("d", "u", 12, "y", 3.0, 3.1)]
    assert found(spark, rows) == {(4, 9, 2), (7, 12, 2)}
    assert found(spark, seq(["a", "a", "a"]), max_gap_s=0.4) == set()
    assert found(spark, seq(["a", "a", "a"]), max_gap_s=0.5) == {(0, 2, 3)}


def test_duration(spark):
    df = spark.createDataFrame([(*r, 1, "x") for r in seq(["a", "a"])], KIND)
    assert [(r.start_s, r.end_s, r.duration_s, r.key) for r in rn.event_runs(df).collect()] == [(0.0, 1.5, 1.5, "a")]


def test_runs_across_shards(spark):
    words = ["a"] * 30 + ["b"] + ["c"] * 9
    assert found(spark, seq(words), shard_s=4.0) == {(0, 29, 30), (31, 39, 9)}


def test_empty_and_null_keys(spark):
    assert found(spark, []) == set()
    rows = [(None, "u", 1, "a", 0.0, 1.0), (None, "u", 2, "a", 1.0, 2.0), ("d", None, 3, "a", 0.0, 1.0)]
    assert found(spark, rows) == {(1, 2, 2)}


def test_hot_utterance(spark):
    rng = random.Random(3)
    words = [rng.choice("ab") for _ in range(20_000)]
    want, i = set(), 0
    while i < len(words):
        j = i
        while j + 1 < len(words) and words[j + 1] == words[i]:
            j += 1
        if j > i:
            want.add((i, j, j - i + 1))
        i = j + 1
    assert found(spark, seq(words, step=0.5)) == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["a", "A", "b", "bb", None, "c1", "c2"]), max_size=40), st.sampled_from([1.0, 3.0, 600.0]))
def test_random_against_grouping(spark, words, shard):
    keys = [None if w is None else {"bb": "b"}.get(w.lower(), w.lower()) for w in words]
    want, i = set(), 0
    while i < len(keys):
        j = i
        while j + 1 < len(keys) and keys[i] is not None and keys[j + 1] == keys[i]:
            j += 1
        if j > i:
            want.add((i, j, j - i + 1))
        i = j + 1
    assert found(spark, seq(words), shard_s=shard) == want


def slow(keys, limit):
    """Merges the best neighbours of the whole list again and again."""
    groups = [[k] for k in keys]
    while True:
        scores = [min(rn.similarity(a, b) for a in x for b in y) for x, y in zip(groups, groups[1:], strict=False)]
        if not scores or max(scores) < limit:
            return [len(g) for g in groups]
        i = scores.index(max(scores))
        groups[i : i + 2] = [groups[i] + groups[i + 1]]


def test_agglomeration_by_similarity():
    rng = random.Random(8)
    for _ in range(60):
        keys = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(1, 12))]
        made = rn.agglomerate([rn.Run(i, i, i, i, 1, (k,)) for i, k in enumerate(keys)], 0.6, 9.0)
        assert [r.n for r in made] == slow(keys, 0.6)


def test_most_similar_first(spark):
    assert found(spark, seq(["abcd", "abce", "abce", "abff"]), min_similarity=0.5) == {(0, 3, 4)}
    assert rn.similarity("abc", "abd") == 1 - 1 / 3 and rn.similarity(None, None) == 0.0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["abcd", "abce", "abff", "abcd", "xyz", None]), st.integers(1, 4), st.integers(0, 9)), max_size=30), st.sampled_from([1.0, 3.0, 600.0]), st.sampled_from([0.5, 2.0, float("inf")]))
def test_shards_do_not_change_the_result(spark, events, shard, gap):
    rows, now = [], 0
    for i, (word, step, lasts) in enumerate(events):
        now += step
        rows.append(("d", "u", i, word, float(now), float(now + lasts / 2)))
    whole = rn.agglomerate([rn.Run(r[2], r[2], r[4], r[5], 1, (r[3],)) for r in rows], 0.5, gap)
    assert found(spark, rows, min_similarity=0.5, max_gap_s=gap, shard_s=shard) == {(r.first_id, r.last_id, r.n) for r in whole if r.n > 1}
