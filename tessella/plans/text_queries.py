"""Queries over texts, lexicon and phones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import lexicon as lx
from tessella.functions import text as tx
from tessella.functions import tokens as tk
from tessella.plans import sqltext as q
from tessella.plans.interval_queries import tiers, token_rows
from tessella.queries import query
from tessella.session import table
from tessella.sources import sixfile as six

RAW = "raw AS (SELECT ann_id, arg_max(raw_text, annotated_at) AS t FROM nvv_annotations WHERE raw_text IS NOT NULL GROUP BY 1)"


def raw_texts(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "nvv_annotations").where("raw_text is not null")
    return rows.groupBy("ann_id").agg(F.max_by("raw_text", "annotated_at").alias("t"))


def files(spark: SparkSession, sf: str) -> DataFrame:
    return six.members(table(spark, sf, "ctc_file"))


_ASCII, _WIDE = "".join(tx.ASCII_FORMS), "".join(tx.ASCII_FORMS.values())


@query(
    rf"WITH {RAW} SELECT ann_id, regexp_replace(regexp_replace(regexp_replace(translate(t, '{_ASCII}', '{_WIDE}'), '[\x{{3003}}-\x{{3020}}\x{{3030}}\x{{303D}}-\x{{303F}}\x{{3000}}\x{{FF02}}-\x{{FF0B}}\x{{FF0D}}-\x{{FF0F}}\x{{FF1C}}-\x{{FF1E}}\x{{FF20}}-\x{{FFEF}}]', '，', 'g'), '^$', ''), "
    r"'([，。！？、；：…])[，。！？、；：…]+', '\1', 'g') AS text FROM raw"
)
def i1_punct_inline(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with inline punctuation normalised."""
    return raw_texts(spark, sf).select("ann_id", tx.punct_inline(F.col("t")).alias("text"))


@query(
    rf"WITH {RAW} SELECT ann_id, regexp_replace(regexp_replace(translate(t, '{_ASCII}', '{_WIDE}'), '[^\p{{L}}\p{{M}}\p{{N}}\s<>\[\]|_\-]{{2,}}', '，', 'g'), "
    r"'[^\p{L}\p{M}\p{N}\s<>\[\]|_\-，。！？、；：…]', '，', 'g') AS text FROM raw"
)
def i2_punct_grouped(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with groups of punctuation merged."""
    return raw_texts(spark, sf).select("ann_id", tx.punct_grouped(F.col("t")).alias("text"))


@query("SELECT doc_id, translate(text, '0123456789', '零一二三四五六七八九') AS text FROM documents WHERE text IS NOT NULL")
def i3_digits_spelled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with digits as ideographs."""
    return table(spark, sf, "documents").where("text is not null").select("doc_id", tx.digits_spelled(F.col("text")).alias("text"))


_PROTECTED = r"(\[[^\]]*\]|<[^>]*>|[A-Z][A-Z0-9-]*[A-Z0-9]|[\s\S])"
_ZH = "'0123456789', '" + "".join(tx.DIGITS.values()) + "'"


def _whole_sql(s: str) -> str:
    """A string of digits read as a number."""
    bare = f"ltrim({s}, '0')"
    place = f"(length({bare}) - i)"
    units, great = f"[{q.names(tx.UNITS)}]", f"[{q.names(tx.GREAT_UNITS)}]"
    said = f"array_to_string(list_transform(string_split({bare}, ''), lambda c, i: translate(c, {_ZH}) || CASE WHEN c = '0' THEN '' ELSE {units}[{place} % 4 + 1] END || CASE WHEN {place} % 4 = 0 THEN {great}[{place} // 4 + 1] ELSE '' END), '')"
    for pattern, to in (("零+([万亿])", r"\1"), ("亿万", "亿"), ("零+", "零"), ("零$", ""), ("^一十", "十")):
        said = f"regexp_replace({said}, '{pattern}', '{to}', 'g')"
    return f"(CASE WHEN {bare} = '' THEN '零' WHEN length({bare}) > 16 THEN translate({s}, {_ZH}) ELSE {said} END)"


def _number_sql(p: str) -> str:
    whole, rest = f"regexp_extract({p}, '^[0-9]+')", rf"regexp_extract({p}, '\.([0-9]+)', 1)"
    return f"{_whole_sql(whole)} || CASE WHEN contains({p}, '.') THEN '点' || translate({rest}, {_ZH}) ELSE '' END"


@query(
    f"""WITH t AS (SELECT DISTINCT text FROM documents WHERE regexp_matches(text, '[0-9]')), p AS (SELECT text, regexp_extract_all(text, '{tx.NUMERAL_PIECES}', 1) AS ps FROM t),
n AS (SELECT DISTINCT unnest(ps) AS p FROM p), m AS (SELECT p, CASE WHEN ends_with(p, '年') THEN translate(p, {_ZH}) WHEN ends_with(p, '%') THEN '百分之' || {_number_sql('p')}
  WHEN contains(p, '/') THEN {_whole_sql("split_part(p, '/', 2)")} || '分之' || {_whole_sql("split_part(p, '/', 1)")} ELSE {_number_sql('p')} END AS said FROM n WHERE regexp_matches(p, '^[0-9]'))
SELECT p AS numeral, said FROM m"""
)
def i3_numerals(spark: SparkSession, sf: str) -> DataFrame:
    """Every distinct numeral of the documents as it is read."""
    texts = table(spark, sf, "documents").where(F.col("text").rlike("[0-9]"))
    found = texts.select(F.explode(F.regexp_extract_all("text", F.lit(tx.NUMERAL_PIECES), F.lit(1))).alias("numeral")).where(F.col("numeral").rlike("^[0-9]")).distinct()
    return found.select("numeral", tx.numerals_spelled(F.col("numeral")).alias("said"))


@query(
    rf"""WITH {RAW} SELECT ann_id, array_to_string(list_transform(regexp_extract_all(t, '{_PROTECTED}', 1), lambda p: CASE WHEN length(p) = 1 THEN translate(p, {_ZH}) ELSE p END), '') AS text FROM raw"""
)
def i3_digits_outside_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Annotation texts with digits as ideographs, tags and labels left alone."""
    return raw_texts(spark, sf).select("ann_id", tx.digits_spelled_outside_tags(F.col("t")).alias("text"))


@query(rf"WITH {RAW} SELECT ann_id, array_to_string(regexp_extract_all(t, '{q.UNIT_SHAPE}'), ' ') AS units FROM raw")
def f4_word_units(spark: SparkSession, sf: str) -> DataFrame:
    """Annotation texts cut into ideographs, words and marks."""
    return raw_texts(spark, sf).select("ann_id", F.array_join(tx.text_units(F.col("t")), " ").alias("units"))


@query(f"WITH {RAW} SELECT ann_id, replace(replace(replace(replace(t, '瑞娅', 'ria'), '瑞亚', 'ria'), '瑞雅', 'ria'), '瑞啊', 'ria') AS text FROM raw")
def i4_name_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with the name in Latin letters."""
    return raw_texts(spark, sf).select("ann_id", tx.name_restored(F.col("t")).alias("text"))


@query(r"WITH lab AS (SELECT DISTINCT interval_id, text FROM tier_interval WHERE lower(tier) = 'pinyin' AND text IS NOT NULL) SELECT interval_id, regexp_replace(regexp_replace(text, 'rui[0-5]\s+ya[0-5]', 'ria', 'g'), 'rui[0-5]\s+a[0-5]', 'ria', 'g') AS text FROM lab")
def i5_name_fragments(spark: SparkSession, sf: str) -> DataFrame:
    """Pinyin lines with the name's fragments joined."""
    rows = table(spark, sf, "tier_interval").where("lower(tier) = 'pinyin' and text is not null").select("interval_id", "text").distinct()
    return rows.select("interval_id", tx.name_fragments_joined(F.col("text")).alias("text"))


@query(
    rf"""WITH {RAW}, p AS (SELECT ann_id, list_transform(regexp_extract_all(t, '(\[[^\]]+\]|[^\[]+|\[)', 1), lambda x: CASE WHEN regexp_matches(x, '^\[[^\]]+\]$') THEN ' ' || replace(upper(x[2:-2]), ' ', '-') || ' ' ELSE x END) AS parts FROM raw)
SELECT ann_id, array_to_string(parts, '') AS text FROM p"""
)
def i6_label_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with bracketed labels as tokens."""
    return raw_texts(spark, sf).select("ann_id", tx.labels_to_tokens(F.col("t")).alias("text"))


@query("SELECT doc_id, regexp_replace(text, '[^，。！？、；：…㐀-䶿一-鿿\\p{L}\\p{N}\\s<>\\[\\]|\\-]', '', 'g') AS text FROM documents WHERE text IS NOT NULL")
def i7_supported_only(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without unsupported marks."""
    return table(spark, sf, "documents").where("text is not null").select("doc_id", tx.supported_only(F.col("text")).alias("text"))


@query("SELECT regexp_matches(text, '[぀-ヿ]') AS kana, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1")
def i8_kana(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with and without kana."""
    return table(spark, sf, "documents").where("text is not null").groupBy(tx.has_kana(F.col("text")).alias("kana")).agg(F.count(F.lit(1)).alias("n"))


@query()
def i9_ellipses(spark: SparkSession, sf: str) -> DataFrame:
    """Annotation texts with ellipses cleaned and repeated labels joined."""
    return raw_texts(spark, sf).select("ann_id", tx.repeated_labels_joined(tx.ellipses_cleaned(F.col("t"))).alias("text"))


def _last(values: tuple[str, ...], name: str) -> str:
    return f"list_filter(tags, lambda x: x IN ({q.names(values)}))[-1] AS {name}"


@query(
    rf"WITH {RAW}, p AS (SELECT ann_id, t, regexp_extract_all(t, '<\|([^|]+)\|>', 1) AS tags, regexp_extract_all(t, '\[([A-Za-z][^\]]*?)\]', 1) AS kinds FROM raw) "
    rf"SELECT ann_id, {_last(tx.LANGUAGES, 'language')}, {_last(tx.EMOTIONS, 'emotion')}, {_last(tx.MODES, 'itn_mode')}, len(kinds) AS events, "
    r"regexp_replace(regexp_replace(regexp_replace(t, '<\|[^|]+\|>', '', 'g'), '\[[A-Za-z][^\]]*?\]', '', 'g'), '^\s+|\s+$', '', 'g') AS clean FROM p"
)
def i11_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Tags, number of events and clean text of annotations."""
    values = tx.tag_values(F.col("t"))
    return raw_texts(spark, sf).select("ann_id", *[v.alias(k) for k, v in values.items()], F.size(tx.label_events(F.col("t"))).alias("events"), tx.without_tags(F.col("t")).alias("clean"))


@query(
    rf"WITH {RAW}, p AS (SELECT ann_id, t, regexp_extract_all(t, '\[([A-Za-z][^\]]*?)\]', 1) AS kinds, regexp_split_to_array(t, '\[[A-Za-z][^\]]*?\]') AS gaps FROM raw), "
    "e AS (SELECT ann_id, kinds, gaps, unnest(range(1, len(kinds) + 1)) AS i FROM p) "
    "SELECT ann_id, kinds[i] AS type, CAST(list_sum(list_transform(gaps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(kinds[1:i-1], lambda x: len(x) + 2)), 0) AS INTEGER) AS char_position FROM e"
)
def i11_events(spark: SparkSession, sf: str) -> DataFrame:
    """Label events with their offsets in the text as written."""
    return raw_texts(spark, sf).select("ann_id", F.explode(tx.label_events(F.col("t"))).alias("e")).select("ann_id", "e.type", "e.char_position")


@query(f"WITH {RAW} SELECT ann_id, CASE WHEN length(t) - length(replace(t, '，', '')) >= 2 THEN list_aggregate(string_split(t, '，')[1:2], 'string_agg', '，') || list_aggregate(string_split(t, '，')[3:], 'string_agg', '，') ELSE t END AS text FROM raw")
def i12_second_comma(spark: SparkSession, sf: str) -> DataFrame:
    """Texts without their second comma."""
    return raw_texts(spark, sf).select("ann_id", tx.nth_char_removed(F.col("t"), "，", 2).alias("text"))


_CLASS = (
    f"CASE WHEN text IS NULL OR {q.silence('text')} THEN 'silence' WHEN {q.vocal('text')} THEN 'vocalisation' WHEN {q.pinyin('text')} THEN 'pinyin' WHEN {q.english('text')} THEN 'english' "
    f"WHEN regexp_matches(text, '^[一-鿿]') THEN 'cjk' WHEN {q.word_like('text')} THEN 'word' ELSE 'punct' END"
)


@query(f"WITH {q.IV} SELECT tier, {_CLASS} AS class, count(*) AS n FROM iv WHERE tier IN ('words', 'hanzi') GROUP BY 1, 2")
def i13_token_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Words and hanzi by class of their text."""
    return tiers(spark, sf, "words", "hanzi").groupBy("tier", tk.token_class(F.col("text")).alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"WITH {q.IV}, lx AS (SELECT DISTINCT lower(token) AS low FROM lexicon WHERE token IS NOT NULL) SELECT {_CLASS} AS class, low IS NOT NULL AS known, count(*) AS n "
    "FROM iv LEFT JOIN lx ON lower(text) = low WHERE tier = 'words' GROUP BY 1, 2"
)
def i18_valid_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words by class and by whether the lexicon has them."""
    known = table(spark, sf, "lexicon").where("token is not null").select(F.lower("token").alias("low")).distinct()
    rows = tiers(spark, sf, "words").withColumn("low_", F.lower("text")).join(known, F.col("low_") == F.col("low"), "left")
    return rows.groupBy(tk.token_class(F.col("text")).alias("class"), F.col("low").isNotNull().alias("known")).agg(F.count(F.lit(1)).alias("n"))


_PHONE_STRIP = q.strip("text")
_MANDARIN = (
    f"({_PHONE_STRIP} IN ({q.names(tk.PINYIN_INITIALS)}) OR regexp_matches({_PHONE_STRIP}, '[1-5]$') OR regexp_matches({_PHONE_STRIP}, '[{tk.TONE_LETTERS}]') "
    f"OR regexp_matches({_PHONE_STRIP}, '^[a-z{tk.MANDARIN_LETTERS}]*[{tk.MANDARIN_LETTERS}][a-z{tk.MANDARIN_LETTERS}]*$'))"
)
_EN_PHONES = q.names((*tk.ENGLISH_VOWELS, *tk.ENGLISH_CONSONANTS, *tk.PHONE_SILENCE))
_VOWEL = f"(lower({_PHONE_STRIP}) NOT IN ({q.names(tk.INITIALS)}) AND regexp_matches(lower({_PHONE_STRIP}), '[1-5]$|[{tk.TONE_LETTERS}]'))"


@query(
    f"WITH {q.IV} SELECT text, {_VOWEL} AS vowel, (lower({_PHONE_STRIP}) IN ({q.names(tk.INITIALS)}) OR ({_PHONE_STRIP} <> '' AND NOT {_VOWEL})) AS consonant, "
    f"({_PHONE_STRIP} <> '' AND {_PHONE_STRIP} NOT IN ({q.names(tk.PHONE_SILENCE)}) AND NOT starts_with({_PHONE_STRIP}, 'en:') AND regexp_replace({_PHONE_STRIP}, '[012]+$', '') NOT IN ({_EN_PHONES}) "
    f"AND {_MANDARIN}) AS mandarin, count(*) AS n FROM iv WHERE tier = 'pinyin_phones' AND text IS NOT NULL GROUP BY ALL"
)
def i19_phone_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Phones by class."""
    t = F.col("text")
    return tiers(spark, sf, "pinyin_phones").where("text is not null").groupBy("text", tk.is_vowel_phone(t).alias("vowel"), tk.is_consonant_phone(t).alias("consonant"), tk.looks_chinese_phone(t).alias("mandarin")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {q.IV} SELECT interval_id, rtrim(rtrim(CAST(round(CAST(CAST(xmin AS VARCHAR) AS DECIMAL(38, 20)), 6) AS DECIMAL(38, 6))::VARCHAR, '0'), '.') AS xmin_text, '\"' || replace(text, '\"', '\"\"') || '\"' AS quoted FROM iv WHERE tier = 'words' AND text IS NOT NULL")
def i23_value_formats(spark: SparkSession, sf: str) -> DataFrame:
    """Bounds and texts as they are written."""
    return tiers(spark, sf, "words").where("text is not null").select("interval_id", tx.seconds_text(F.col("xmin")).alias("xmin_text"), tx.quoted(F.col("text")).alias("quoted"))


# J


@query(
    f"WITH {q.IV}, e AS (SELECT token, arg_max(phones, line_no) AS phones, min(line_no) AS line_no FROM lexicon WHERE token IS NOT NULL GROUP BY 1), k AS (SELECT lower(token) AS low, arg_min(token, line_no) AS token, arg_min(phones, line_no) AS phones FROM e GROUP BY 1) "
    f"SELECT interval_id, token, array_to_string(phones, ' ') AS phones FROM iv LEFT JOIN k ON lower({q.strip('text')}) = low WHERE tier = 'words'"
)
def j1_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Words with their lexicon entry."""
    out = lx.lookup(tiers(spark, sf, "words"), "text", table(spark, sf, "lexicon"))
    return out.select("interval_id", "token", F.array_join("phones", " ").alias("phones"))


def _marked(finals: dict[str, list[str]]) -> str:
    """Finals as SQL values, their parts in one text with a star for the tone."""
    return ", ".join("('" + k + "', '" + " ".join(x + "*" * (i == (k in lx.TONE_ON_SECOND)) for i, x in enumerate(v)) + "')" for k, v in finals.items())


_FINALS_VALUES = _marked(lx.FINALS)


@query(
    f"WITH f(base, spec) AS (VALUES {_FINALS_VALUES}), p AS (SELECT DISTINCT u.phone FROM lexicon, unnest(phones) AS u(phone)) "
    "SELECT phone, coalesce(replace(spec, '*', regexp_extract(phone, '([1-5])$', 1)), phone) AS parts FROM p LEFT JOIN f ON regexp_matches(phone, '[1-5]$') AND base = regexp_extract(phone, '^(.+?)[1-5]$', 1)"
)
def j2_decomposed(spark: SparkSession, sf: str) -> DataFrame:
    """Finals in parts."""
    phones = table(spark, sf, "lexicon").select(F.explode("phones").alias("phone")).distinct()
    return phones.select("phone", F.array_join(lx.decomposed(F.col("phone")), " ").alias("parts"))


def _ipa_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lexicon").select("line_no", "token", lx.ipa_entry(F.col("token"), F.col("phones")).alias("phones")).where("phones is not null")


_IPA_VALUES = _marked(lx.FINALS_IPA)
_INIT_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in lx.pinyin_initials().items())
_TONE_CASE = "CASE {t} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in lx.TONES.items()) + " END"


_IPA_CTE = f"""fin(base, spec) AS (VALUES {_IPA_VALUES}), ini(py, ipa) AS (VALUES {_INIT_VALUES}),
e AS (SELECT line_no, token, phones, len(phones) AS n, phones[1] AS a, phones[2] AS b FROM lexicon),
x AS (SELECT *, regexp_extract(CASE n WHEN 1 THEN a WHEN 2 THEN b END, '([1-5])$', 1) AS tone, regexp_extract(CASE n WHEN 1 THEN a WHEN 2 THEN b END, '^(.+?)[1-5]$', 1) AS base FROM e),
y AS (SELECT x.*, {_TONE_CASE.format(t='tone')} AS letters, ini.ipa, fin.spec FROM x LEFT JOIN ini ON x.n = 2 AND ini.py = x.a LEFT JOIN fin ON fin.base = x.base),
ipalex AS (SELECT line_no, token, CASE WHEN n = 1 AND tone <> '' THEN replace(spec, '*', letters)
  WHEN n = 2 AND ipa IS NOT NULL AND tone <> '' THEN ipa || ' ' || CASE WHEN a IN ('z', 'c', 's') AND starts_with(b, 'i0') THEN 'z̩' || letters WHEN starts_with(b, 'ir') THEN 'ʐ̩' || letters ELSE replace(spec, '*', letters) END
  ELSE array_to_string(phones, ' ') END AS phones FROM y WHERE len(list_filter(phones, lambda p: regexp_matches(p, '^[A-Z]+[0-9]$'))) = 0 AND NOT (tone <> '' AND spec IS NULL AND (n = 1 OR n = 2 AND ipa IS NOT NULL AND NOT starts_with(b, 'ir'))))"""


@query(f"WITH {_IPA_CTE} SELECT * FROM ipalex")
def j5_ipa_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """The lexicon in phonetic notation."""
    return _ipa_lexicon(spark, sf).select("line_no", "token", F.array_join("phones", " ").alias("phones"))


_FIXED_VALUES = ", ".join(f"('{k}', '{v}', 0, 0)" for k, v in lx.IPA_INITIALS.items() if v) + ", " + ", ".join(
    f"('{v + t}', '{p + d}', 2, {i})" for i, (v, p, t, d) in enumerate((v, p, t, d) for v, p in lx.IPA_VOWELS.items() for t, d in lx.TONE_SPELLINGS.items())
)
_MAP_CTE = rf"""{_IPA_CTE}, dec(dbase, dspec) AS (VALUES {_FINALS_VALUES}), known(ipa, pinyin, rank, place) AS (VALUES {_FIXED_VALUES}),
pin AS (SELECT token, arg_max(phones, line_no) AS phones, min(line_no) AS line_no FROM lexicon WHERE token IS NOT NULL GROUP BY token),
one AS (SELECT token, line_no, unnest(phones) AS phone, generate_subscripts(phones, 1) AS k FROM pin),
parted AS (SELECT token, line_no, string_split(string_agg(coalesce(replace(dspec, '*', regexp_extract(phone, '([1-5])$', 1)), phone), ' ' ORDER BY k), ' ') AS parts
  FROM one LEFT JOIN dec ON regexp_matches(phone, '[1-5]$') AND dbase = regexp_extract(phone, '^(.+?)[1-5]$', 1) GROUP BY token, line_no),
heard AS (SELECT token, string_split(arg_max(phones, line_no), ' ') AS phones FROM ipalex WHERE token IS NOT NULL GROUP BY token),
crossed AS (SELECT unnest(heard.phones) AS ipa, unnest(parts) AS pinyin, 1 AS rank, line_no * 1000 + generate_subscripts(parts, 1) - 1 AS place FROM parted JOIN heard USING (token) WHERE len(parts) = len(heard.phones)),
ipamap AS (SELECT ipa, arg_min(pinyin, (rank, place)) AS pinyin FROM (SELECT * FROM known UNION ALL SELECT * FROM crossed) GROUP BY ipa)"""


@query(f"WITH {_MAP_CTE} SELECT c.ipa, c.pinyin, count(*) AS n, c.pinyin = any_value(m.pinyin) AS agrees FROM crossed c JOIN ipamap m ON m.ipa = c.ipa GROUP BY 1, 2")
def j15_map_check(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of phones in both lexicons, and whether the map agrees."""
    return lx.map_check(table(spark, sf, "lexicon"), _ipa_lexicon(spark, sf))


@query("SELECT lower(token) AS word, array_to_string(arg_min(phones, line_no), ' ') AS phones FROM lexicon WHERE regexp_matches(token, '^[A-Za-z]+$') AND len(phones) > 0 GROUP BY 1")
def j14_stress_entries(spark: SparkSession, sf: str) -> DataFrame:
    """The English lines of the lexicon as a pronouncing dictionary."""
    rows = table(spark, sf, "lexicon").where(F.col("token").rlike("^[A-Za-z]+$"))
    lines = rows.select("line_no", F.concat_ws(" ", "token", F.array_join("phones", " ")).alias("value"))
    return lx.stress_entries(lines).select("word", F.array_join("phones", " ").alias("phones"))


@query(f"WITH {_MAP_CTE} SELECT ipa, pinyin FROM ipamap")
def j3_ipa_map(spark: SparkSession, sf: str) -> DataFrame:
    """Phonetic phones and their pinyin."""
    return lx.ipa_to_pinyin(table(spark, sf, "lexicon"), _ipa_lexicon(spark, sf))


@query(
    f"""WITH {_MAP_CTE}, ph AS (SELECT DISTINCT interval_id, dataset, stem, ord, xmin, xmax, text, {_PHONE_STRIP} AS t FROM tier_interval WHERE lower(tier) = 'pinyin_phones')
SELECT interval_id, CASE WHEN {q.silence('text')} THEN {q.grade('xmax - xmin')} ELSE coalesce(pinyin, t) END AS text FROM ph LEFT JOIN ipamap ON ipa = t"""
)
def c2_mapped_phones(spark: SparkSession, sf: str) -> DataFrame:
    """Phones one to one by the map."""
    return lx.mapped_phones(tiers(spark, sf, "pinyin_phones", bounded=False), j3_ipa_map(spark, sf)).select("interval_id", "text")


@query(
    f"""WITH {_MAP_CTE}, t AS (SELECT *, regexp_extract(ipa, '[{tk.TONE_LETTERS}]+') AS letters, regexp_extract(pinyin, '[1-5]$') AS digit FROM ipamap)
SELECT 'consonants' AS section, ipa AS key, pinyin AS value FROM t WHERE letters = ''
UNION ALL SELECT 'vowel_with_tones', regexp_replace(ipa, '[{tk.TONE_LETTERS}]+', '', 'g') || ' -> ' || pinyin, min(ipa) FROM t WHERE letters <> '' GROUP BY 2
UNION ALL SELECT 'tone_marks', letters, max(CASE WHEN digit = '' THEN '?' ELSE digit END) FROM t WHERE letters <> '' GROUP BY 2"""
)
def j4_tone_reference(spark: SparkSession, sf: str) -> DataFrame:
    """The map regrouped by consonants, toned vowels and tone letters."""
    return lx.tone_reference(j3_ipa_map(spark, sf))


_AR_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in lx.ENGLISH_OF_IPA.items())


@query(
    f"WITH m(ipa, ar) AS (VALUES {_AR_VALUES}), {q.IV}, p AS (SELECT {_PHONE_STRIP} AS t, count(*) AS n FROM iv WHERE tier = 'pinyin_phones' AND text IS NOT NULL GROUP BY 1) "
    f"SELECT t AS phone, CASE WHEN t IN ({q.names(tk.PHONE_SILENCE)}) OR t = '' THEN t ELSE coalesce(ar, t) END AS arpabet, n FROM p LEFT JOIN m ON m.ipa = t"
)
def j6_arpabet(spark: SparkSession, sf: str) -> DataFrame:
    """Phones as English phones."""
    rows = tiers(spark, sf, "pinyin_phones").where("text is not null").groupBy(tk.stripped(F.col("text")).alias("phone")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select("phone", lx.arpabet(F.col("phone")).alias("arpabet"), "n")


@query(
    rf"""WITH {q.IV}, w AS (SELECT * FROM iv WHERE tier = 'words' AND xmax > xmin AND {q.english('text')}), p AS (SELECT * FROM iv WHERE tier = 'pinyin_phones' AND xmax > xmin),
m AS (SELECT w.interval_id AS word_id, w.text AS word, p.interval_id AS part_id, p.text AS text, row_number() OVER (PARTITION BY p.dataset, p.stem, p.interval_id ORDER BY w.xmin, w.interval_id) AS r
  FROM w JOIN p USING (dataset, stem) WHERE p.xmin < w.xmax - 0.001 AND p.xmax > w.xmin + 0.001), ar(ipa, ar) AS (VALUES {_AR_VALUES}),
x AS (SELECT *, {_PHONE_STRIP} AS t, starts_with(text, 'en:') AS en FROM m WHERE r = 1),
y AS (SELECT x.*, coalesce(ar, CASE WHEN en THEN {_PHONE_STRIP}[4:] ELSE t END) AS a, NOT en AND t <> '' AND NOT {q.silence('text')} AND NOT (t NOT IN ({q.names(tk.PHONE_SILENCE)})
  AND NOT regexp_replace(t, '[012]+$', '') IN ({q.names((*tk.ENGLISH_VOWELS, *tk.ENGLISH_CONSONANTS, *tk.PHONE_SILENCE))}) AND {_MANDARIN}) AS other FROM x LEFT JOIN ar ON ipa = CASE WHEN en THEN t[4:] ELSE t END)
SELECT word_id, part_id, word, text AS part, CASE WHEN (en OR other) AND a <> '' THEN 'en:' || a END AS label FROM y"""
)
def j7_english_phones(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of the phones under English words."""
    from tessella.operators import intervals as iv

    rows = tiers(spark, sf, "words", "pinyin_phones").where("xmax > xmin")
    words = rows.where((F.col("tier") == "words") & tk.is_english(F.col("text")))
    parts = iv.parts_in_words(words, rows.where("tier = 'pinyin_phones'"))
    label = lx.english_phone_label(F.col("part"), F.col("xmin"), F.col("xmax"), F.col("xmin"), F.col("xmax"))
    return parts.select("word_id", "part_id", "word", "part", label.alias("label"))


_LAB = f"lab AS (SELECT DISTINCT interval_id, text FROM tier_interval WHERE lower(tier) = 'pinyin' AND text IS NOT NULL), lt AS (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS token FROM lab)"


def _line_tokens(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "tier_interval").where("lower(tier) = 'pinyin' and text is not null").select("interval_id", "text").distinct()
    return rows.select(F.explode(F.split("text", r"\s+")).alias("token"))


@query(f"WITH {_LAB} SELECT token, count(*) AS n FROM lt WHERE {q.english('token')} GROUP BY 1")
def j8_english_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """English tokens of the transcripts and how often they occur."""
    return _line_tokens(spark, sf).where(tk.is_english(F.col("token"))).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query("WITH d AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS token FROM documents WHERE text IS NOT NULL) SELECT token FROM d WHERE lower(token) NOT IN (SELECT lower(token) FROM lexicon WHERE token IS NOT NULL)")
def j9_missing_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Words of the documents that the lexicon lacks in any letter case."""
    words = table(spark, sf, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z]+)"), F.lit(1))).alias("token")).distinct()
    return lx.missing_tokens(words, table(spark, sf, "lexicon"))


@query("WITH d AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS word FROM documents WHERE text IS NOT NULL) SELECT word, sha1(word) AS cache_key FROM d WHERE word NOT IN (SELECT lower(regexp_replace(token, '\\(.*$', '')) FROM lexicon WHERE token IS NOT NULL)")
def j10_out_of_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """Lower-case words without an entry, with the key of their cached pronunciation."""
    words = table(spark, sf, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z]+)"), F.lit(1))).alias("token"))
    return lx.out_of_vocabulary(words, table(spark, sf, "lexicon"))


@query(f"WITH m(ipa, ar) AS (VALUES {_AR_VALUES}), {q.IV} SELECT text, CASE WHEN ar = '' THEN 'dropped' WHEN ar IS NOT NULL AND {_PHONE_STRIP} NOT IN ({q.names(tk.PHONE_SILENCE)}) AND ar <> {_PHONE_STRIP} THEN 'mapped' ELSE 'kept' END AS state, count(*) AS n FROM iv LEFT JOIN m ON m.ipa = {_PHONE_STRIP} WHERE tier = 'pinyin_phones' AND text IS NOT NULL AND {_PHONE_STRIP} <> '' GROUP BY 1, 2")
def j16_phone_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Phones that the English map covers."""
    from tessella.operators.qc import phone_coverage

    return phone_coverage(tiers(spark, sf, "pinyin_phones").where(F.col("text").isNotNull() & (tk.stripped(F.col("text")) != ""))).select("text", "state", "n")


@query(f"WITH {q.TOK} SELECT {_CLASS} AS class, count(*) AS n, count(DISTINCT text) AS kinds FROM tok GROUP BY 1")
def i22_token_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens by the class they are dispatched to."""
    return token_rows(spark, sf).groupBy(tk.token_class(F.col("text")).alias("class")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("text").alias("kinds"))
