import pytest

from tessella.plans import pipeline as pl
from tessella.session import shared_dir
from tessella.streaming import microbatch as mb


def test_settings_and_steps():
    assert pl.merged({"a": {"b": 1, "c": [1]}, "d": 2}, {"a": {"c": [2]}, "d": {"e": 3}}) == {"a": {"b": 1, "c": [2]}, "d": {"e": 3}}
    assert pl.steps_of("ctc_ready", skip_to="align", skip=["align_en"]) == ["align", "postprocess"]
    assert pl.steps_of("full", only="resample") == ["resample"]
    with pytest.raises(ValueError):
        pl.steps_of("full", only="link")


def test_pipeline_passes_tables_on():
    steps = {s: (lambda t, c, s=s: {"log": [*t.get("log", []), s]}) for s in pl.ORDERS["ctc_ready"] if s not in pl.EXTERNAL}
    out = pl.Pipeline(steps, {"mfa_en": {"padding_ms": 10}}).run({}, "ctc_ready", skip_to="resample")
    assert out["log"] == ["resample", "adjust", "postprocess"]
    with pytest.raises(ValueError):
        pl.Pipeline({}).run({}, "ctc_ready")


def test_selected(spark):
    df = spark.createDataFrame([("c",), ("a",), ("b",)], "name string")
    assert [r.name for r in pl.selected(df, exclude=["a"], limit=1).collect()] == ["b"]
    assert pl.selected(df, include=["a", "x"]).count() == 1


KIND = "dataset string, stem string, mode string"


def test_stream_resumes_and_retries(spark):
    work = shared_dir(spark, "test")
    first = spark.createDataFrame([("d", f"s{i}", "full") for i in range(6)], KIND)
    first.repartition(3).write.parquet(f"{work}/in")
    drop = lambda df: df.where("stem <> 's1'").withColumn("error", mb.F.when(mb.F.col("stem") == "s2", "broken"))
    args = (spark, f"{work}/in", KIND)
    tail = (f"{work}/out", f"{work}/ledger", f"{work}/checkpoint", 1)
    mb.run_available(*args, drop, *tail)
    ledger = mb.read_ledger(spark, f"{work}/ledger")
    assert {r.stem for r in ledger.where("status = 'error'").collect()} == {"s1", "s2"} and ledger.count() == 6
    assert {r.stem for r in mb.pending(first, ledger).collect()} == {"s1", "s2"}
    state = mb.dataset_states(ledger, first).first()
    assert (state.wanted, state.done, state.failed, state.complete) == (6, 4, 2, False)
    spark.createDataFrame([("d", "s9", "full")], KIND).write.mode("append").parquet(f"{work}/in")
    mb.run_available(*args, lambda df: df, *tail)
    again = mb.read_ledger(spark, f"{work}/ledger")
    assert again.count() == 7 and [r.status for r in again.where("stem = 's9'").collect()] == ["ok"]
    assert mb.pending(first, None).count() == 6 and mb.read_ledger(spark, f"{work}/nothing") is None


def test_batches_and_modes(spark):
    df = spark.createDataFrame([("d", f"s{i}", i % 2 == 0) for i in range(5)], "dataset string, stem string, complete boolean")
    assert sorted(r.batch for r in mb.batches(df, 2).collect()) == [0, 0, 1, 1, 2]
    assert {r.mode for r in mb.with_mode(df).collect()} == {"ctc_ready", "nvrasr_fallback"}


def test_event_windows(spark):
    df = spark.createDataFrame([("2024-01-01 00:10:00", 1, 2.0), ("2024-01-01 00:50:00", 1, 4.0), ("2024-01-01 01:00:00", 1, 9.0)], "t string, user_id int, value double")
    got = mb.event_windows(df.selectExpr("cast(t as timestamp) as ts", "user_id", "value")).collect()
    assert sorted((r.n, r["mean"]) for r in got) == [(1, 9.0), (2, 3.0)]


def test_wired_steps(spark):
    from tessella.plans import steps

    anchors = [("d", "u", "token", 1, 0.0, 0.2, "rui1"), ("d", "u", "token", 2, 0.2, 0.5, "ya4"), ("d", "u", "token", 3, 0.5, 0.8, "mo"), ("d", "u", "token", 4, 0.8, 1.0, "del"), ("d", "u", "punct", 9, 1.0, 1.1, ","), ("d", "v", "token", 5, 0.0, 0.2, "de5")]
    intervals = [("d", u, t, i, 0.0, 1.0, x) for i, (u, t, x) in enumerate([("u", "words", "ria"), ("u", "raw_text", "old"), ("v", "words", "de5"), ("w", "words", "x1")])]
    tables = {
        "anchors": spark.createDataFrame(anchors, steps._ANCHOR), "intervals": spark.createDataFrame(intervals, "dataset string, stem string, tier string, interval_id bigint, xmin double, xmax double, text string"),
        "texts": spark.createDataFrame([("d", "u", "15 瑞娅,model")], "dataset string, stem string, text string"), "records": spark.createDataFrame([("D", "U", True), ("d", "v", False)], "dataset string, stem string, complete boolean"),
    }
    out = pl.Pipeline(steps.STEPS).run(tables, "ctc_ready", skip=["postprocess"])
    assert [r.text for r in out["texts"].collect()] == ["十五 ria，model"]
    assert sorted((r.kind, r.interval_id, r.xmin, r.xmax, r.text) for r in out["anchors"].collect()) == [("punct", 9, 1.0, 1.1, "，"), ("token", 1, 0.0, 0.5, "ria"), ("token", 3, 0.5, 1.0, "model")]
    done = pl.Pipeline(steps.STEPS).run(out, "ctc_ready", only="postprocess")
    assert done["fused"].where("error is not null").count() == 0 and {r.tier for r in done["fused"].collect()} >= {"words", "hanzi", "raw_text"}
    assert {r.stem for r in done["statuses"].collect()} == {"u"}
    assert steps.trim({"audio": spark.createDataFrame([("d", "u", 100, [0.5] * 300)], "dataset string, stem string, sample_rate int, samples array<float>")}, pl.DEFAULTS)["audio"].first().sample_rate == 100
