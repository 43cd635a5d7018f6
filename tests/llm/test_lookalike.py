import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessella.llm import lookalike as lk


def plain_form(text):
    """Folded in plain Python, by another path."""
    return unicodedata.normalize("NFC", "".join(map(lk.fold_char, text)))


def forms(spark, texts):
    df = spark.createDataFrame([(t, 1) for t in texts], "text string, pos int")
    return {r.text: r.form for r in lk.text_forms(df).collect()}


def test_every_canonical_pair_recomposes(spark):
    texts = [x for p, c in lk.compositions().items() for x in (p, c, f"a{p}b", p + "́")]
    texts += [unicodedata.normalize("NFD", chr(c)) for c in range(0xAC00, 0xD7A4, 37)] + ["한국어 말", "각ᆨ", "가ᅡ", "ᅡᄀ", "ᄀ́ᅡ", "\u09c7\u0323\u09be"]
    got = forms(spark, texts)
    assert [(t, f) for t, f in got.items() if f != plain_form(t)] == []


def test_pairs_that_look_the_same(spark):
    pairs = [("ｈｅｌｌｏ１", "hello1"), ("café", "café"), ("a​b­️", "ab"), ("a b c　d\te", "a b c d e"), ("рагty ΑВС", "paгty ABC"), ("⼈⼝⺠", "人口民"), ("ɡo", "go"), ("ﾊﾟ", "パ"), ("q̣̇", "q̣̇"), ("ệ", "ệ"), ("𝐀b", "Ab"), ("，！", ",!"), ("각", "각")]
    got = forms(spark, [x for p in pairs for x in p])
    assert [(a, b) for a, b in pairs if got[a] != got[b]] == []


def test_real_differences_stay(spark):
    pairs = [("Abc", "abc"), ("ma1", "ma2"), ("cafe", "café"), ("O0", "00"), ("l1", "11"), ("über", "uber"), ("a b", "ab"), ("a  b", "a b"), ("…", "..."), ("ﬁ", "fi"), ("a\nb", "a b"), ("−", "-")]
    got = forms(spark, [x for p in pairs for x in p])
    assert [(a, b) for a, b in pairs if got[a] == got[b]] == []


def test_nulls_empty_long_and_astral(spark):
    long = "ｘé" * 40_000
    got = forms(spark, ["", None, long, "😀Ａ", "", "́x", "​"])
    assert got == {"": "", long: "xé" * 40_000, "😀Ａ": "😀A", "́x": "́x", "​": ""}
    assert forms(spark, []) == {}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from("aeoABｚȩ̣́́̂ＡａｏсеﾊﾞΑ⼈​  1ñ가각"), max_size=9), max_size=6))
def test_random_against_plain(spark, texts):
    got = forms(spark, texts)
    assert got == {t: plain_form(t) for t in texts}
    again = forms(spark, list(got.values()))
    assert all(again[f] == f for f in got.values())


ANN = "ann_id bigint, dataset string, stem string, raw_text string, form string"
IV = "interval_id bigint, tier string, text string, tid int"
LEX = "line_no int, token string, fid int"


def found(spark, anns=(), ivs=(), lex=()):
    a = spark.createDataFrame([(*r, "x") for r in anns], ANN)
    b = spark.createDataFrame([(*r, 1) for r in ivs], IV)
    c = spark.createDataFrame([(*r, 1) for r in lex], LEX)
    return {tuple(r) for r in lk.lookalikes(a, b, c).collect()}


def test_annotations(spark):
    rows = [(1, "d", "u", "ab"), (2, "d", "u", "ａb"), (2, "d", "u", "ａb"), (3, "d", "u", "ab"), (4, "d", "v", "ａb"), (5, "e", "u", "ａb"), (6, "d", "u", None), (None, "d", "u", "ａｂ"), (7, None, "u", "ab"), (8, None, "u", "ａb"), (9, "d", "u", "AB")]
    assert found(spark, rows) == {("annotation", 1, 2), ("annotation", 2, 3)}


def test_words_against_lexicon(spark):
    lex = [(5, "café"), (3, "café"), (4, "Café"), (9, None), (7, "o")]
    ivs = [(1, "Words", "café"), (1, "Words", "café"), (2, "words", "café"), (3, "hanzi", "café"), (4, "words", "cafe"), (5, "WORDS", "Ｃafé"), (6, "words", None), (None, "words", "café"), (8, "words", "ο")]
    assert found(spark, (), ivs, lex) == {("interval", 3, 1), ("interval", 4, 5), ("interval", 7, 8)}


def test_empty_tables(spark):
    assert found(spark) == set()


def test_hot_text(spark):
    ivs = [(i, "words", "ｄe5") for i in range(500)] + [(1000 + i, "words", "de5") for i in range(500)]
    assert found(spark, (), ivs, [(1, "de5")]) == {("interval", 1, i) for i in range(500)}


def test_tables_of_characters():
    rows = lk.fold_rows()
    assert len(rows) == len({c for c, _ in rows}) < 40_000
    assert all(lk.fold_char(p) == p for _, parts in rows for p, _ in parts)
    assert not any(c.isascii() and c.isalnum() for c, _ in rows)
