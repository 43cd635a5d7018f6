import pytest
from pyspark.sql import functions as F

from tessella.functions import lexicon as lx

CASES = [("ai1", "a1 i"), ("ao1", "a1 u"), ("ian1", "i e1 n"), ("iao1", "i a1 u"), ("uai1", "u a1 i"), ("iou1", "i o1 u"), ("ve1", "v e1"), ("ia1", "i a1"), ("ua1", "u a1"), ("er2", "e2 r"), ("iang1", "i a1 ng"), ("ir1", "ir1"), ("i01", "i01"), ("an1", "a1 n"), ("i1", "i1"), ("zh", "zh"), ("odd1", "odd1")]


@pytest.mark.parametrize(("phone", "parts"), CASES)
def test_decomposed(phone, parts):
    assert lx.py_decomposed(phone) == parts.split()


def test_decomposed_column(spark):
    df = spark.createDataFrame(CASES, "p string, want string")
    assert df.where(F.array_join(lx.decomposed(F.col("p")), " ") != F.col("want")).count() == 0


def test_parts_stand_one_to_one():
    same = set(lx.FINALS) & set(lx.FINALS_IPA)
    assert all(len(lx.FINALS[k]) == len(lx.FINALS_IPA[k]) for k in same)


def entries(spark, rows):
    return spark.createDataFrame(rows, "line_no int, token string, phones array<string>")


def test_ipa_entries(spark):
    rows = [(1, "a1", ["a1"]), (2, "zhi1", ["zh", "ir1"]), (3, "zi1", ["z", "i01"]), (4, "tian2", ["t", "ian2"]), (5, "hello", ["HH", "AH0"]), (6, "<PAUSE>", ["sil"]), (7, "SIGH", ["SIGH"]), (8, "empty", [])]
    got = {r.token: r.p for r in entries(spark, rows).select("token", lx.ipa_entry(F.col("token"), F.col("phones")).alias("p")).collect()}
    assert got == {"a1": ["a˥"], "zhi1": ["ʈʂ", "ʐ̩˥"], "zi1": ["ts", "z̩˥"], "tian2": ["tʰ", "j", "e˧˥", "n"], "hello": None, "<PAUSE>": ["spn"], "SIGH": ["SIGH"], "empty": None}


def test_map_inverts_decomposition(spark):
    rows = [(1, "tian1", ["t", "ian1"]), (2, "ai1", ["ai1"]), (3, "zhi2", ["zh", "ir2"])]
    lex = entries(spark, rows)
    ipa = lex.select("line_no", "token", lx.ipa_entry(F.col("token"), F.col("phones")).alias("phones"))
    mapping = {r.ipa: r.pinyin for r in lx.ipa_to_pinyin(lex, ipa).collect()}
    for (_, token, phones), made in zip(rows, [r.phones for r in ipa.orderBy("line_no").collect()], strict=True):
        want = [x for p in phones for x in lx.py_decomposed(p)]
        fixed = {"j": "i"}
        assert [mapping[p] for p in made] == [fixed.get(w, w) if p in fixed else w for p, w in zip(made, want, strict=True)], token
    assert mapping["a˥˥"] == "a1" and mapping["ŋ"] == "ng" and "ʔ" not in mapping
    sections = {r.section for r in lx.tone_reference(lx.ipa_to_pinyin(lex, ipa)).collect()}
    assert sections == {"consonants", "vowel_with_tones", "tone_marks"}


def test_english_phones(spark):
    df = spark.createDataFrame([(x,) for x in ("tʃ", "en:tʃ", "ʔ", "en:ʔ", "sil", "AA1", "en:AA1", "ɛ̃")], "p string")
    assert [r[0] for r in df.select(lx.arpabet(F.col("p"))).collect()] == ["CH", "en:CH", "", "", "sil", "AA1", "en:AA1", "EH0"]


def test_lookup_and_missing(spark):
    lex = entries(spark, [(3, "Demo", ["B"]), (1, "demo", ["A"]), (2, "demo", ["C"])])
    rows = spark.createDataFrame([(1, " DEMO "), (2, "other"), (3, None)], "i int, text string")
    got = {r.i: (r.token, r.phones) for r in lx.lookup(rows, "text", lex).collect()}
    assert got == {1: ("demo", ["C"]), 2: (None, None), 3: (None, None)}
    tokens = spark.createDataFrame([("DEMO",), ("New",), ("New",)], "token string")
    assert [r.token for r in lx.missing_tokens(tokens, lex).collect()] == ["New"]
    oov = lx.out_of_vocabulary(tokens, entries(spark, [(1, "demo(2)", ["A"])])).collect()
    assert [(r.word, len(r.cache_key)) for r in oov] == [("new", 40)]
