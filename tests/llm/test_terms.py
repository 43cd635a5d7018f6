from collections import Counter

from pyspark.sql import functions as F

from tessella.llm import terms

KIND = "ann_id bigint, emotion string, nvv_events array<struct<type:string,char_position:int>>, annotated_at int, term string, record int"


def freq(spark, rows):
    df = spark.createDataFrame([(i, e, None if t is None else [(x, 0) for x in t], at, "x", 1) for i, e, t, at in rows], KIND)
    return {(r.field, r.term): (r.occurrences, r.records, r.mark) for r in terms.annotation_terms(df).collect()}


def test_cleaning(spark):
    given = ["[Breathing]", " <|A_b  c|> ", "\tX", "[ ]", "", None, "a[b]c", "　wide　x ", "A__B", "-x-"]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, t string").select("i", terms.clean_term(F.col("t")).alias("t"))
    assert [r.t for r in df.orderBy("i").collect()] == ["breathing", "a-b-c", "x", None, None, None, "a[b]c", "wide-x", "a-b", "-x-"]


def test_counts_marks_and_versions(spark):
    rows = [(i, "HAPPY" if i < 5 else None, ["Sigh", "[sigh]"] if i < 4 else [], 1) for i in range(24)]
    rows += [(0, "HAPPY", ["Sigh", "[sigh]"], 1), (1, "SAD", ["Cough", None], 2), (None, "X", ["Y"], 1), (30, "SAD", None, 1)]
    got = freq(spark, rows)
    assert got == {("emotion", "happy"): (4, 4, "rare"), ("emotion", "sad"): (2, 2, "rare"), ("nvv_events", "sigh"): (6, 3, "rare"), ("nvv_events", "cough"): (1, 1, "rare")}


def test_limits(spark):
    # 25 records: five hold a, six hold b
    got = freq(spark, [(i, None, ["a"] * (i < 5) + ["b"] * (i < 6) + ["c"] * (i < 4), 1) for i in range(25)])
    assert {t: m for (_, t), (_, _, m) in got.items()} == {"a": None, "b": "common", "c": "rare"}


def test_empty(spark):
    assert freq(spark, []) == {}


def test_hot_term_and_long_list(spark):
    rows = [(i, "HOT", ["x"] * (2000 if i == 0 else 1), 1) for i in range(400)]
    assert freq(spark, rows) == {("emotion", "hot"): (400, 400, "common"), ("nvv_events", "x"): (2399, 400, "common")}


def test_against_counting(spark):
    import random

    rng = random.Random(5)
    rows = [(i, rng.choice(["A", "b ", None]), [rng.choice(["x", "[X]", "y_z", "Y z", None]) for _ in range(rng.randrange(5))], 1) for i in range(120)]
    occ, rec = Counter(), Counter()
    for _, e, ts, _ in rows:
        all_ = [("emotion", e.strip().lower())] if e else []
        all_ += [("nvv_events", {"x": "x", "[X]": "x", "y_z": "y-z", "Y z": "y-z"}[t]) for t in ts if t]
        occ.update(all_)
        rec.update(set(all_))
    assert {k: v[:2] for k, v in freq(spark, rows).items()} == {k: (occ[k], rec[k]) for k in occ}
