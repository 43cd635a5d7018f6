import pytest

from tessella.operators import packing as pk

KIND = "file_id bigint, path string, size_bytes bigint, modified_at timestamp, content string, same string"


def files(spark, tmp_path, rows):
    path = f"{tmp_path}/files.parquet"
    spark.createDataFrame([(i, p, None, None, c, "x") for i, p, c in rows], KIND).repartition(3).write.parquet(path)
    return path


def found(spark, tmp_path, rows):
    return {tuple(r) for r in pk.consolidate(spark, files(spark, tmp_path, rows))[1].collect()}


def test_repeats_by_record_and_content(spark, tmp_path):
    a = "/mnt/x/Set/wavs/u1.lab"
    rows = [
        (5, a, "de5 le5\n"), (3, "\\\\filer\\x\\SET\\WAVS\\u1\\u1.LAB", "\ufeffde5 le5\r\n"), (9, "P:/y//set/wavs/./u1.lab", "de5 le5 \u3000\n\n"),
        (7, "/mnt/x/Set/wavs/u1.lab", "de5 le6\n"), (8, "/mnt/x/Set/wavs/u2.lab", "de5 le5\n"), (4, "/mnt/x/Other/wavs/u1.lab", "de5 le5\n"),
        (11, "/mnt/x/Set/wavs/u3.lab", ""), (12, "/mnt/x/Set/wavs/u3/u3.lab", " \n"), (13, "/mnt/x/Set/wavs/u3.lab", None), (14, None, ""), (15, "/mnt/x/Set/u1.lab", "de5 le5\n"),
        (16, "/mnt/x/Set/wavs/u1_notes.md", "de5"), (17, "/mnt/x/Set/wavs/u1_notes.md", "de5"), (None, a, "de5 le5\n"), (5, a, "de5 le5\n"),
    ]
    assert found(spark, tmp_path, rows) == {(3, 5), (3, 9), (11, 12)}


def test_white_space_inside_and_before_counts(spark, tmp_path):
    a = "/mnt/x/s/wavs/u_text_cn.txt"
    assert found(spark, tmp_path, [(1, a, "a b"), (2, a, "a  b"), (3, a, " a b"), (4, a, "a\nb"), (5, a, "a\r\nb"), (6, a, "a\rb")]) == {(4, 5), (4, 6)}


def test_record_columns(spark):
    df = spark.createDataFrame([("/a/D/wavs/s_1/s_1_tokens.jsonl",), ("D\\wavs\\s_text_raw.txt",), ("/D/wavs/.lab",), ("/D/wav/s.lab",)], "p string")
    rec = pk.record_columns(df["p"])
    assert [tuple(r) for r in df.select(*rec.values()).collect()] == [("d", "s_1", "_tokens.jsonl"), ("d", "s", "_text_raw.txt"), (None, None, None), (None, None, None)]


def test_long_content_and_hot_record(spark, tmp_path):
    a, long = "/m/s/wavs/u.lab", "x" * 1_000_000
    rows = [(i, a, long) for i in range(3)] + [(100 + i, "/m/s/wavs/v.lab", "same") for i in range(300)]
    assert found(spark, tmp_path, rows) == {(0, 1), (0, 2)} | {(100, 100 + i) for i in range(1, 300)}


def test_empty_table(spark, tmp_path):
    assert found(spark, tmp_path, []) == set()


def test_staged_in_few_files_and_held_once(spark, tmp_path):
    rows = [(i, f"/m/s/wavs/u{i % 10}.lab", f"text {i % 20}") for i in range(60)] + [(None, None, None)] * 2
    packing = pk.Packing(file_bytes=1 << 30)
    staged, repeated = pk.consolidate(spark, files(spark, tmp_path, rows), packing)
    assert staged.count() == 62 and len(staged.inputFiles()) == 1
    held = pk.hold_once(staged, repeated, f"file://{tmp_path}/store", packing)
    assert held.count() == 22 and held.where("is_latest").count() == 10
    assert sorted((r.rec_stem, r.content) for r in held.where("rec_stem is not null").collect()) == sorted((f"u{i % 10}", f"text {i}") for i in range(20))
    with pytest.raises(pk.PackingError):
        pk.publish(spark, f"file://{tmp_path}/store", f"file://{tmp_path}/store")


def test_lost_row_is_noticed(spark, tmp_path, monkeypatch):
    df = spark.range(10).selectExpr("id", "cast(id as string) as t")
    one = df.agg(*pk.fingerprint(df, df.columns)).first()
    assert one != df.where("id < 9").agg(*pk.fingerprint(df, df.columns)).first()
    assert one != df.unionByName(df.where("id = 3")).agg(*pk.fingerprint(df, df.columns)).first()
    calls = []
    monkeypatch.setattr(pk, "fingerprint", lambda d, c: calls.append(1) or [(pk.F.count(pk.F.lit(1)) - len(calls)).alias("rows")])
    with pytest.raises(pk.PackingError):
        pk.stage(df, f"file://{tmp_path}/staged")


def test_split_settings_stay_with_the_scan(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    for i in range(12):
        spark.range(1).write.mode("append").parquet(f"{tmp_path}/many")
    df = pk.read_packed(spark, f"{tmp_path}/many", pk.Packing(split_bytes=64 << 20, open_cost_bytes=1))
    assert df.rdd.getNumPartitions() <= 12 and df.count() == 12
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_folder_of_tiny_files(spark, tmp_path):
    for i in range(1500):
        (tmp_path / f"f{i}.lab").write_text(f"tok{i}\n")
    df = pk.read_packed(spark, str(tmp_path), fmt="binaryFile", pathGlobFilter="*.lab")
    assert df.rdd.getNumPartitions() < 40
    staged, sizes = pk.stage(df, f"file://{tmp_path}/staged", also=lambda d: d.select("length"))
    assert len(staged.inputFiles()) == 1 and sizes.count() == 1500
    assert {bytes(r.content).decode() for r in staged.select("content").collect()} == {f"tok{i}\n" for i in range(1500)}
