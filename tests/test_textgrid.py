import random

import pytest

from tessella.sources import sixfile as six
from tessella.sources import textgrid as tg

GRID = '''File type = "ooTextFile"
Object class = "TextGrid"

xmin = 0 
xmax = 1.5 
tiers? <exists> 
size = 2 
item []: 
    item [1]:
        class = "IntervalTier" 
        name = "words" 
        xmin = 0 
        xmax = 1.5 
        intervals: size = 2 
        intervals [0]:
            xmin = 0 
            xmax = 0.52 
            text = "" 
        intervals [1]:
            xmin = 0.52 
            xmax = 1.5 
            text = "say ""hi""
there" 
    item [2]:
        class = "IntervalTier"
        name = "phones"
        xmin = 0
        xmax = 1.5
        intervals: size = 2
        intervals [1]:
            xmin = 0.4
            xmax = 0.9
            text = "a"
        intervals [2]:
            xmin = 0.9
            xmax = 1.6
            text = "b"
'''


def test_parse_variants(spark):
    df = spark.createDataFrame([(1, GRID)], "k int, content string")
    rows = [tuple(r) for r in tg.interval_rows(df, ["k"]).orderBy("tier_ord", "ord").collect()]
    assert rows[:2] == [(1, 0, "words", 0, 0.0, 0.52, ""), (1, 0, "words", 1, 0.52, 1.5, 'say "hi"\nthere')]
    assert [(t, [tuple(i) for i in r]) for t, r in tg.parse(GRID)][0][1] == [(0.0, 0.52, ""), (0.52, 1.5, 'say "hi"\nthere')]
    words = tg.words_with_phones(tg.interval_rows(df, ["k"]), ["k"]).collect()
    assert [(w.word, [tuple(p) for p in w.phones]) for w in words] == [('say "hi"\nthere', [("a", 0.52, 0.9), ("b", 0.9, 1.5)])]


@pytest.mark.parametrize("bad", ["", "xmin = 0\nintervals [1]:", GRID.replace("xmax = 0.9", "xmax"), GRID[:700].rsplit("xmax", 1)[0]])
def test_unreadable(spark, bad):
    df = spark.createDataFrame([(1, bad)], "k int, content string")
    assert tg.unreadable(df, ["k"]).count() == 1 and tg.interval_rows(df, ["k"]).count() == 0
    with pytest.raises(ValueError):
        tg.parse(bad)


def rows_of(rng, utterances=4):
    out = []
    for u in range(utterances):
        for t, tier in enumerate(("words", "phones")):
            at = 0.0
            for i in range(rng.randrange(1, 6)):
                end = round(at + rng.random(), 6)
                out.append((f"u{u}", t, tier, i, at, end, rng.choice(["", "x", '"q"', "今\n天", "a b"])))
                at = end
    return out


KIND = "stem string, tier_ord int, tier string, ord int, xmin double, xmax double, text string"


def test_round_trip(spark, tmp_path):
    want = rows_of(random.Random(1))
    df = spark.createDataFrame(want, KIND)
    again = tg.interval_rows(tg.rendered(df, ["stem"]), ["stem"])
    assert sorted(map(tuple, again.collect())) == sorted(want)
    assert tg.write_folder(df, str(tmp_path / "out"), ["stem"]).count() == 4
    assert sorted(map(tuple, tg.read_folder(spark, str(tmp_path / "out")).collect())) == sorted(want)
    spark.dataSource.register(tg.TextGridSource)
    loaded = spark.read.format("textgrid").load(str(tmp_path / "out"))
    assert sorted(map(tuple, loaded.collect())) == sorted(want)


def test_members(spark):
    rows = [
        (1, "/m/S/wavs/u.lab", "﻿a  b\n"), (2, "/m/S/wavs/u/u_tokens.jsonl", '{"word": "a", "start_s": 0.1, "end_s": 0.2}\n\n{"word": "b", "sta'),
        (3, "/m/S/wavs/./u_punct.json", '[{"word": "，", "start_s": 1.0, "end_s": 1.5, "start_ms": 1000.0, "end_ms": 1500.0}]'), (4, "/m/S/wavs/u_text_cn.txt", ""),
        (5, "/m/S/wavs/u_text_raw.txt", "raw"), (6, "/m/S/wavs/v/v.lab", "c"), (7, None, "x"),
    ]
    files = spark.createDataFrame([(i, p, None, c) for i, p, c in rows], "file_id bigint, path string, modified_at timestamp, content string")
    m = six.members(files)
    assert {(r.file_id, r.layout) for r in m.collect()} == {(1, "flat"), (2, "nested"), (3, "flat"), (4, "flat"), (5, "flat"), (6, "nested")}
    assert [(r.ord, r.word, r.type, r.broken) for r in six.token_lines(m).orderBy("ord").collect()] == [(0, "a", None, False), (1, None, None, True)]
    assert [(r.ord, r.word, r.end_s) for r in six.punct_entries(m).collect()] == [(0, "，", 1.5)]
    assert [r.token for r in six.lab_tokens(m).orderBy("file_id", "ord").collect()] == ["a", "b", "c"]
    assert [(r.stem, r.suffix) for r in six.first_of_chain(m, ["_text_cn.txt", "_text_raw.txt", ".lab"]).orderBy("stem").collect()] == [("u", "_text_raw.txt"), ("v", ".lab")]
    index = {(r.suffix, r.stem) for r in six.file_index(m).collect()}
    assert (".lab", "u") in index and (".lab", "v") not in index and ("_tokens.jsonl", "u") in index
    audio = spark.createDataFrame([("s", "u"), ("s", "v")], "dataset string, stem string")
    assert {(r.stem, r.layout, r.complete) for r in six.completeness(m, audio).collect()} == {("u", "flat", False), ("v", "nested", False)}
    assert six.check_layout(files, ["%.lab", "%.wav"]) == ["%.wav"]


def test_complete_in_its_own_layout(spark):
    names = [".TextGrid", ".lab", "_tokens.jsonl", "_punct.json", "_text_cn.txt", "_text_raw.txt"]
    rows = [(i, f"/m/S/wavs/u{n}") for i, n in enumerate(names)] + [(10 + i, f"/m/S/wavs/{'v/' if i % 2 else ''}v{n}") for i, n in enumerate(names)]
    files = spark.createDataFrame([(i, p, None, "x") for i, p in rows], "file_id bigint, path string, modified_at timestamp, content string")
    audio = spark.createDataFrame([("s", "u"), ("s", "v")], "dataset string, stem string")
    m = six.members(files)
    assert {(r.stem, r.complete) for r in six.completeness(m, audio).collect()} == {("u", True), ("v", False)}
    assert {(r.stem, r.complete) for r in six.completeness(m, audio, one_layout=False).collect()} == {("u", True), ("v", True)}


def test_wav_candidates(spark):
    want = spark.createDataFrame([("d", "7"), ("d", "00009"), ("d", "x_12"), ("d", "none")], "dataset string, stem string")
    audio = spark.createDataFrame([("d", "00007"), ("d", "0000007"), ("d", "00009"), ("d", "voice_12"), ("d", "voice_112"), ("e", "none")], "dataset string, stem string")
    got = {(r.stem, r.rule, r.audio_stem) for r in six.wav_candidates(want, audio).collect()}
    assert got == {("7", 2, "00007"), ("00009", 1, "00009"), ("x_12", 9, "voice_12")}


def test_lexicon_lines(spark):
    lines = spark.createDataFrame([(0, "﻿a1  a1"), (1, "one"), (2, " ba1\tb a1 ")], "line_no int, value string")
    assert [(r.token, r.phones) for r in six.lexicon_lines(lines).orderBy("line_no").collect()] == [("a1", ["a1"]), ("ba1", ["b", "a1"])]


def test_reference_texts_and_the_whole_chain(spark):
    kind = "file_id bigint, path string, modified_at timestamp, content string"
    paths = [
        (1, "/m/Set/wavs/u1.txt", "plain"), (2, "/m/Set/wavs/u1_qwen3.txt", "heard"), (3, "/m/Set/wavs/u1_text_cn.txt", "clean"), (4, "P:\\Set\\u2_firered.txt", "two"), (5, "/m/Set/wavs/u3_text_raw.txt", "raw"),
        (6, "/m/Set/wavs/u1_qwen3-api.lab", ""), (7, "/m/Set/wavs/u4.txt", " \n"), (8, "/m/Set/wavs/u4.lab", "de5"), (9, "/m/Set/wavs/u5_firered.lab", ""), (10, "/m/Set/wavs/u5.lab", "le5"), (11, None, "x"),
    ]
    files = spark.createDataFrame([(i, p, None, c) for i, p, c in paths], kind)
    refs = six.reference_index(files)
    assert sorted((r.stem, r.file_id, r.rank) for r in refs.collect()) == [("u1", 1, 0), ("u1", 2, 2), ("u2", 4, 3)]
    got = {(r.stem, r.source, r.content) for r in six.resolved_texts(six.members(files), refs).collect()}
    assert got == {
        ("u1", ".txt", "plain"), ("u2", ".txt_firered", "two"), ("u3", "_text_raw.txt", "raw"), ("u4", ".lab", "de5"), ("u5", ".lab", "le5"), ("u1_qwen3-api", ".txt", "plain"), ("u5_firered", ".lab", "le5"),
    }


def test_very_long_texts(spark):
    long = "字" * 200_000 + 'say "x" ' * 500
    df = spark.createDataFrame([("d", "u", 1, "words", 0, 0.0, 1.0, long)], "dataset string, stem string, tier_ord int, tier string, ord int, xmin double, xmax double, text string")
    again = tg.interval_rows(tg.rendered(df, ["dataset", "stem"]), ["dataset", "stem"]).collect()
    assert [r.text for r in again] == [long]
