import struct

import numpy as np
import pytest

from tessella.functions import lexicon as lx
from tessella.operators import qc
from tessella.sources import sixfile as six
from tessella.sources import wave

from .test_kernels import SR, audio_of, tone


def riff(fmt, body):
    return b"RIFF" + struct.pack("<I", 36 + len(body)) + b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(body)) + body


def test_formats():
    x = tone(0.1)
    y, rate = wave.decoded(wave.encoded(x, SR))
    assert rate == SR and np.abs(x - y).max() < 1e-4
    stereo = np.column_stack([x, np.zeros_like(x)])
    data = riff(struct.pack("<HHIIHH", 3, 2, SR, SR * 8, 8, 32), stereo.astype("<f4").tobytes())
    assert np.allclose(wave.decoded(data)[0], x) and np.allclose(wave.decoded(data, "mean")[0], x / 2)
    ext = struct.pack("<HHIIHH", 0xFFFE, 1, SR, SR * 3, 3, 24) + struct.pack("<HHIH", 22, 24, 4, 1) + bytes(14)
    assert np.allclose(wave.decoded(riff(ext, b"\x00\x00\x40\x00\x00\xc0"))[0], [0.5, -0.5])
    assert np.allclose(wave.decoded(riff(struct.pack("<HHIIHH", 1, 1, SR, SR, 1, 8), bytes([128, 192])))[0], [0, 0.5])
    for bad in (b"", b"RIFFxxxxWAVE", riff(struct.pack("<HHIIHH", 7, 1, SR, SR, 1, 8), b"ab")):
        with pytest.raises(ValueError):
            wave.decoded(bad)


def test_folders(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.wav").write_bytes(wave.encoded(audio_of((0.5, 0.3), (3.0, 0), (0.5, 0.3)), SR))
    (tmp_path / "in" / "b.wav").write_bytes(wave.encoded(np.sin(np.arange(8000)), 8000))
    (tmp_path / "in" / "c.wav").write_bytes(b"nothing")
    rows = wave.read_folder(spark, str(tmp_path / "in"), SR)
    got = {r.stem: (r.sample_rate, None if r.samples is None else len(r.samples), r.error) for r in rows.collect()}
    assert got == {"a": (SR, 4 * SR, None), "b": (SR, SR, None), "c": (None, None, "no RIFF/WAVE data")}
    out = {r.stem: r.seconds for r in wave.write_folder(rows, str(tmp_path / "out")).collect()}
    assert set(out) == {"a", "b"} and abs(out["a"] - 3.0) < 0.15
    assert len(wave.decoded((tmp_path / "out" / "a.wav").read_bytes())[0]) == round(out["a"] * SR)


WORDS = [(0.0, 0.5, "ba1"), (0.5, 1.0, "<sp2>"), (1.0, 1.5, "de5"), (1.5, 2.0, "<sp2>")]


def test_background():
    quiet = audio_of((0.5, 0.3), (0.5, 0), (0.5, 0.3), (0.5, 0))
    assert qc.background_suspect(WORDS, quiet, SR) is None
    hum = audio_of((0.9, 0), (0.1, 0.3), (0.5, 0), (0.5, 0.3))
    found = qc.background_suspect(WORDS, hum, SR)
    assert found["suspect_intervals"] == 2 and found["suspect_ratio"] == 1.0
    assert qc.background_suspect([(0.0, 2.0, "ba1")], hum, SR) is None


def test_words_in_silence():
    x = audio_of((0.5, 0), (0.5, 0), (0.5, 0.3), (0.5, 0))
    assert qc.words_in_silence(WORDS, x, SR) == []
    assert [i["text"] for i in qc.words_in_silence(WORDS, x, SR, 2.0)] == ["ba1"]
    assert qc.words_in_silence([(0.0, 0.5, "ba1"), (0.5, 1.0, "SIGH"), (1.0, 1.5, "，")], x, SR, 2.0) == []


def test_phone_tables(spark):
    mapping = spark.createDataFrame([("a˥", "a1")], "ipa string, pinyin string")
    rows = spark.createDataFrame([(1, 0.0, 1.0, "a˥ "), (2, 1.0, 1.1, "sil"), (3, 0.0, 1.0, "zz")], "i int, xmin double, xmax double, text string")
    assert [r.text for r in lx.mapped_phones(rows, mapping).orderBy("i").collect()] == ["a1", "<sp0>", "zz"]
    texts = spark.createDataFrame([(1, "今 a，天"), (2, None)], "i int, t string")
    readings = spark.createDataFrame([("今", "jin1")], "char string, pinyin string")
    assert [(r.char, r.unit) for r in lx.char_units(texts, ["i"], "t", readings).orderBy("pos").collect()] == [("今", "jin1"), ("a", "a"), ("，", "，"), ("天", "天")]
    lines = spark.createDataFrame([(0, ";;; note"), (1, "HELLO  HH AH0"), (2, "hello(2) HH EH0"), (3, "x")], "line_no int, value string")
    assert [(r.word, r.phones) for r in lx.stress_entries(lines).collect()] == [("hello", ["HH", "AH0"])]


def test_absolute_phones(spark):
    kind = "dataset string, stem string, seg_idx int, offset double, word_text string, word_start double, word_end double, aligned struct<start:double,end:double,phones:array<struct<phone:string,start:double,end:double>>>"
    df = spark.createDataFrame([("d", "u", 0, 1.5, "hi", 1.5, 2.0, (0.1, 0.4, [("HH", 0.1, 0.2)])), ("d", "u", 0, 1.5, "no", 2.0, 2.5, None)], kind)
    got = {r.word_text: (r.en_word_start, [tuple(p) for p in r.phones]) for r in lx.absolute_phones(df).collect()}
    assert got == {"hi": (1.6, [("HH", 1.6, 1.7)]), "no": (None, [])}


def test_reorganised(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "dataset string, x int").repartition(3)
    six.reorganised(rows, f"{tmp_path}/o")
    back = spark.read.parquet(f"{tmp_path}/o")
    assert back.count() == 3 and len(list((tmp_path / "o" / "dataset=a").glob("*.parquet"))) == 1
