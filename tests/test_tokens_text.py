import pytest
from pyspark.sql import functions as F

from tessella.functions import text as tx
from tessella.functions import tokens as tk


def values(spark, make, *inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, t string").select("i", make(F.col("t")).alias("v"))
    return [r.v for r in df.orderBy("i").collect()]


WORDS = ["", " ", "<sp1>", "spn", "<eps>", "sil", "SIL", "BREATHING", "<breathing>", " QUESTION-EN ", "PAUSE", "jin1", "Jin1", "hello", "web-site", "12", "今", "，", "-", "<unk>", "BGM", "é"]


def test_classes_agree_with_kernels(spark):
    pairs = ((tk.is_silence, tk.py_silence), (tk.is_vocalisation, tk.py_vocalisation), (tk.is_pinyin, tk.py_pinyin), (tk.is_english, tk.py_english), (tk.is_word_like, tk.py_word_like), (tk.is_punct, tk.py_punct))
    for column, plain in pairs:
        assert values(spark, column, *WORDS) == [plain(w) for w in WORDS], column.__name__


def test_sizes_of_fixed_values():
    assert len(tk.VOCALISATIONS) == 29 and len(tk.LABEL_TOKENS) == 30 and len(tk.INITIALS) == 26


@pytest.mark.parametrize(("d", "grade"), [(0.1999, "<sp0>"), (0.2, "<sp1>"), (0.4999, "<sp1>"), (0.5, "<sp2>"), (1.4999, "<sp2>"), (1.5, "<sp3>")])
def test_grades_at_their_limits(spark, d, grade):
    assert tk.py_grade(d) == grade
    assert spark.range(1).select(tk.silence_grade(F.lit(d))).first()[0] == grade


def test_capital_labels_are_wider_than_vocalisations(spark):
    assert values(spark, tk.is_upper_label, "BGM", "A", "QUESTION-EN", "A-", "Ab") == [True, False, True, False, False]


def test_phones(spark):
    assert values(spark, tk.is_vowel_phone, "a1", "e˥", "tɕ", "x", "B") == [True, True, False, False, False]
    assert values(spark, tk.is_consonant_phone, "a1", "tɕ", "zh", " ") == [False, True, True, False]
    assert values(spark, tk.looks_chinese_phone, "ian3", "e˥", "zh", "en:AA0", "AA1", "sil", "ʂ", "θ") == [True, True, True, False, False, False, True, False]


def test_punctuation(spark):
    assert values(spark, tx.punct_inline, "a,b.。c", "「好」！？", "（１）x", None, "") == ["a，b。c", "，好，", "，１，x", None, ""]
    assert values(spark, tx.punct_grouped, "a,.b", "好~吧!", "QUESTION-EN", "[A]<b>") == ["a，b", "好，吧！", "QUESTION-EN", "[A]<b>"]


def test_numerals_names_labels(spark):
    assert values(spark, tx.digits_spelled, "2024年") == ["二零二四年"]
    assert values(spark, tx.digits_spelled_outside_tags, "<|t1|>3[Cup-2]A1B 4") == ["<|t1|>三[Cup-2]A1B 四"]
    assert values(spark, tx.name_restored, "瑞娅和瑞啊") == ["ria和ria"]
    assert values(spark, tx.name_fragments_joined, "a rui4 ya4 b rui4  a5") == ["a ria b ria"]
    assert values(spark, tx.labels_to_tokens, "好[Breathing]的[Odd one]", "[", "[]x") == ["好 BREATHING 的 ODD-ONE ", "[", "[]x"]


def test_filters(spark):
    assert values(spark, tx.supported_only, "「a-1」今，(b) <|x|>") == ["a-1今，b <|x|>"]
    assert values(spark, tx.has_kana, "あ", "ア", "今") == [True, True, False]
    assert values(spark, tx.ellipses_cleaned, "…，a", "a，…", "a……b", "<|zh|>…b", "，UHM…", "[Sigh] [Sigh]", "[Sigh]，[Sigh]") == ["，a", "a，", "a…b", "<|zh|>b", "，UHM", "[Sigh]", "，[Sigh]"]
    assert values(spark, tx.repeated_labels_joined, "SIGH  SIGH a ") == ["SIGH a"]


def test_tags_and_events(spark):
    t = "<|zh|><|HAPPY|><|SAD|><|woitn|>好[Sigh]的[ x][Uhm]"
    got = spark.createDataFrame([(t,)], "t string").select(*[v.alias(k) for k, v in tx.tag_values(F.col("t")).items()], tx.label_events(F.col("t")).alias("e"), tx.without_tags(F.col("t")).alias("c")).first()
    assert (got.language, got.emotion, got.itn_mode) == ("zh", "SAD", "woitn")
    assert [(e.type, e.char_position) for e in got.e] == [("Sigh", t.index("[Sigh]")), ("Uhm", t.index("[Uhm]"))]
    assert got.c == "好的[ x]"


def test_nth_char_and_formats(spark):
    assert values(spark, lambda c: tx.nth_char_removed(c, "，", 2), "a，b，c，d", "a，b", None) == ["a，bc，d", "a，b", None]
    assert values(spark, tx.quoted, 'say "hi"') == ['"say ""hi"""']
    df = spark.createDataFrame([(1.0,), (0.52,), (0.1234567,), (100.0,), (0.0,)], "x double")
    assert [r[0] for r in df.select(tx.seconds_text(F.col("x"))).collect()] == ["1", "0.52", "0.123457", "100", "0"]
    assert [tx.py_seconds_text(x) for x in (1.0, 0.52, 100.0, 0.0)] == ["1", "0.52", "100", "0"]


def test_vocalisations_marked(spark):
    assert values(spark, tx.vocalisations_marked, "a SIGH b", "QUESTION-EN", "XSIGH", "SIGH-X") == ["a <SIGH> b", "<QUESTION-EN>", "XSIGH", "SIGH-X"]


def test_word_units():
    assert tx.word_units("今天 hello-2，x") == ["今", "天", "hello-2", "，", "x"]


def test_numbers_by_place_value(spark):
    cases = {
        "0": "零", "007": "七", "10": "十", "15个": "十五个", "110": "一百一十", "1001": "一千零一", "20305": "二万零三百零五", "100000": "十万", "1000001": "一百万零一", "100000000": "一亿", "100010000": "一亿零一万",
        "100000001": "一亿零一", "1000000000000": "一万亿", "12345678901234567": "一二三四五六七八九零一二三四五六七", "3.05": "三点零五", "25%": "百分之二十五", "1/3": "三分之一", "2024年5月3日": "二零二四年五月三日", "[Pause2] <|a1|> BGM2 7": "[Pause2] <|a1|> BGM2 七", "-4": "-四", "": "",
    }
    assert values(spark, tx.numerals_spelled, *cases) == list(cases.values())


def test_very_long_words(spark):
    df = spark.createDataFrame([("a" * 100_000 + "…" * 1000 + "，" + "9" * 1000,)], "t string")
    row = df.select(F.size(tx.text_units(F.col("t"))).alias("n"), F.length(tx.ellipses_cleaned(F.col("t"))).alias("e"), F.length(tx.numerals_spelled(F.col("t"))).alias("m")).first()
    assert tuple(row) == (1 + 1000 + 1 + 1, 100_000 + 1 + 1 + 1000, 100_000 + 1000 + 1 + 1000)
