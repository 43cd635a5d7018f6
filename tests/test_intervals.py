import random

import pytest
from pyspark.sql import functions as F

from tessella.operators import intervals as iv
from tessella.operators import qc

KIND = "interval_id bigint, dataset string, stem string, tier string, ord int, xmin double, xmax double, text string"


def rows(spark, *items, tier="words", stem="u"):
    return spark.createDataFrame([(i, "d", stem, tier, i, float(a), float(b), t) for i, (a, b, t) in enumerate(items)], KIND)


def test_tiers_once_in_any_case(spark):
    raw = spark.createDataFrame([(1, "d", "u", "Words", 0, 0.0, 1.0, "a", 1), (1, "d", "u", "Words", 0, 0.0, 1.0, "a", 2), (2, "d", "u", "WORDS", 1, None, 2.0, "b", 1), (3, "d", "u", "hanzi", 1, 1.0, 2.0, "c", 1)], KIND + ", ingested_at int")
    assert [r.interval_id for r in iv.tiers(raw, "words").collect()] == [1]
    assert iv.tiers(raw).count() == 2


def test_phone_goes_to_the_earlier_word_only(spark):
    words = rows(spark, (0, 1, "w0"), (1, 2, "w1"))
    phones = rows(spark, (0, 0.5, "a"), (0.5, 1.5, "b"), (1.5, 2, "c"), (0.9995, 1.0005, "d"), tier="p")
    got = {(r.part, r.word, round(r.xmin, 4), round(r.xmax, 4)) for r in iv.parts_in_words(words, phones).collect()}
    assert got == {("a", "w0", 0, 0.5), ("b", "w0", 0.5, 1), ("c", "w1", 1.5, 2)}


def test_best_overlap_first_on_ties(spark):
    anchors = rows(spark, (0, 0.5, "x"), (0.5, 1.0, "y"), (1.0, 1.2, "z")).withColumnRenamed("text", "word")
    got = {r.text: r.word for r in iv.best_overlap(rows(spark, (0.25, 0.75, "tie"), (0.4, 1.1, "y"), (1.2, 2, "none")), anchors).collect()}
    assert got == {"tie": "x", "y": "y"}


@pytest.mark.parametrize(("x", "inside"), [(0.95, True), (0.9499, False)])
def test_containment_tolerance(spark, x, inside):
    row, rng = rows(spark, (x, 1.5, "p")), rows(spark, (1.0, 1.5, "r"))
    assert iv.within_any(row, rng, 0.05).count() == inside
    assert iv.outside_all(row, rng, 0.05).count() == (not inside)


def test_overlap_is_strict(spark):
    assert iv.overlapping_none(rows(spark, (0, 1, "a")), rows(spark, (1, 2, "b"))).count() == 1


def test_bucketed_pairs_equal_plain_ones(spark):
    rng = random.Random(2)
    make = lambda: [(x := rng.random() * 50, x + rng.random() * 9, "t") for _ in range(60)]
    a, b = rows(spark, *make()), rows(spark, *make())
    plain = iv.paired(a, b, (F.col("a_xmax") > F.col("b_xmin")) & (F.col("a_xmin") < F.col("b_xmax")))
    ids = lambda d: sorted((r.a_interval_id, r.b_interval_id) for r in d.collect())
    assert ids(iv.bucketed_pairs(a, b, 4.0)) == ids(plain)


def test_same_text_gap_limit(spark):
    got = iv.same_text_merged(rows(spark, (0, 1, "a"), (1.001, 2, "a"), (2.003, 3, "a"), (3, 4, "b")))
    assert sorted((r.xmin, r.xmax, r.n) for r in got.collect()) == [(0, 2, 2), (2.003, 3, 1), (3, 4, 1)]


def test_english_segments_split_at_the_limit(spark):
    got = iv.word_segments(rows(spark, (0, 1, "a"), (1.1, 1.2, "jin1"), (1.34, 2, "b"), (2.35, 3, "c"), (3, 4, "QUESTION-EN")))
    assert sorted((r.xmin, r.xmax, r.words) for r in got.collect()) == [(0, 2, 2), (2.35, 3, 1)]


def test_next_start_is_strictly_later(spark):
    got = {r.text: r.new_xmax for r in iv.next_start_ends(rows(spark, (1.0, 9, "a"), (1.001, 9, "b"), (1.5, 9, "c"))).collect()}
    assert got == {"a": 1.5, "b": 1.5, "c": 9}


def test_gaps(spark):
    df = rows(spark, (0, 1, "a"), (1, 1.3, "<sp1>"), (1.3, 2, "b"), (2, 2.3, "<sp1>"), (2.3, 2.5, "，"), (2.5, 3, "c"), (3, 3.4, "<sp1>"), (3.4, 4, "SIGH"))
    assert [(r.before, r.after) for r in iv.unexpected_silences(df.withColumn("text", F.when(F.col("text").isin("a", "b", "c"), F.concat("text", F.lit("1"))).otherwise(F.col("text")))).collect()] == [("a1", "b1")]
    assert iv.cross_checked_text(df).first().text == "a [sp] b ， c [sp] SIGH"


def test_fill_gaps(spark):
    df = rows(spark, (0.5, 1.2, "a"), (1.0, 2, "b")).withColumn("utt_end", F.lit(2.5))
    assert sorted((r.xmin, r.xmax, r.text) for r in iv.filled_gaps(df).collect()) == [(0, 0.5, ""), (0.5, 1.0, "a"), (1.0, 2, "b"), (2, 2.5, "")]


def test_finalised(spark):
    df = rows(spark, (0, 1, "好 SIGH"), tier="raw_text").unionByName(rows(spark, (0, 1, "<sp3>"), (1, 2, "<sp2>"), tier="words"))
    got = {(r.tier, r.xmin): r.text for r in iv.finalised(df).collect()}
    assert got == {("raw_text", 0): "<sp1>好 <SIGH>", ("words", 0): "<sp1>", ("words", 1): "<sp2>"}


def test_routing_repeats_reasons(spark):
    df = rows(spark, (0, 1, "今"), (1, 2, "<sp3>"), (2, 4, "<sp3>"), (4, 5, "天"))
    got = qc.routed(df, qc.reasons(df)).first()
    assert got.status == "filtered_incomplete_tiers_tier_desync_sp3_sp3_mid_sp_unexpected_silence" or got.status.count("sp3") == 2
    assert got.distinct_reasons.split(",").count("sp3") == 1


def test_desync_limit(spark):
    def both(n, wrong):
        h = rows(spark, *[(i, i + 1, "今") for i in range(n)], tier="hanzi")
        return h.unionByName(rows(spark, *[(i, i + 1, "今" if i < wrong else "jin1") for i in range(n)], tier="words"))

    assert qc.tier_desync(both(10, 1)).count() == 0 and qc.tier_desync(both(10, 2)).count() == 1


def test_pinyin_in_text(spark):
    df = rows(spark, (0, 1, "<sp1>今yan1天 li3 a yan1"), tier="raw_text")
    assert qc.pinyin_in_text(df).first().hits == ["li3", "yan1"]


def test_phone_duration_limits(spark):
    words = rows(spark, (0, 1, "ba1"), (1, 2, "hello"), (2, 3, "SIGH"))
    phones = rows(spark, (0, 0.014, "b"), (0.1, 0.115, "a1"), (1.0, 1.6, "en:AA1"), (1.6, 1.609, "en:T"), (2.0, 2.001, "x"), tier="pinyin_phones")
    assert sorted((r.rule, r.text) for r in qc.phone_durations(words.unionByName(phones)).collect()) == [("long_vowel_en", "en:AA1"), ("short_phone", "b"), ("short_phone_en", "en:T")]


def test_mapped_phones_without_bounds(spark, small, tmp_path):
    import shutil

    from tessella.plans import text_queries as tq

    shutil.copy(f"{small}/lexicon.parquet", tmp_path)
    rows = [(1, "d", "u", "pinyin_phones", 0, 0.0, 1.0, "b"), (2, "d", "u", "Pinyin_Phones", 1, None, 2.0, "b"), (3, "d", "u", "pinyin_phones", 2, 2.0, None, "b")]
    spark.createDataFrame(rows, KIND).write.parquet(f"{tmp_path}/tier_interval.parquet")
    assert {r.interval_id for r in tq.c2_mapped_phones(spark, str(tmp_path)).collect()} == {1, 2, 3}
