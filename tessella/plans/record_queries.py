"""Queries over the six-file store, quality rules and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions import tokens as tk
from tessella.operators import intervals as iv
from tessella.operators import qc
from tessella.plans import sqltext as q
from tessella.plans.audio_queries import heard
from tessella.plans.interval_queries import UTT, tiers, token_rows
from tessella.plans.text_queries import RAW, files, raw_texts
from tessella.queries import SQL, query
from tessella.session import table
from tessella.sources import sixfile as six
from tessella.sources import textgrid as tg

_SHAPE = r"([^/]+)/wavs/(?:[^/]+/)*([^/]+?)(\.textgrid|\.lab|_tokens\.jsonl|_punct\.json|_text_cn\.txt|_text_raw\.txt)$"
MEM = rf"""f0 AS (SELECT *, lower(replace(path, '\', '/')) AS low FROM ctc_file), f1 AS (SELECT *, regexp_replace(regexp_replace(low, '/(\./)+', '/', 'g'), '/{{2,}}', '/', 'g') AS p FROM f0),
mem AS (SELECT regexp_extract(p, '{_SHAPE}', 1) AS dataset, regexp_extract(p, '{_SHAPE}', 2) AS stem, regexp_extract(p, '{_SHAPE}', 3) AS suffix,
  CASE WHEN regexp_matches(p, '/wavs/[^/]+/[^/]+$') THEN 'nested' ELSE 'flat' END AS layout, file_id, path, modified_at,
  regexp_replace(replace(replace(CASE WHEN starts_with(content, chr(65279)) THEN substr(content, 2) ELSE content END, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '\s+$', '') AS content
  FROM f1 WHERE regexp_matches(p, '/?[^/]+/wavs/(?:[^/]+/)*[^/]+?(\.textgrid|\.lab|_tokens\.jsonl|_punct\.json|_text_cn\.txt|_text_raw\.txt)$'))"""
AUD = r"aud AS (SELECT DISTINCT dataset, regexp_extract(audio, '([^/\\]+)\.wav$', 1) AS stem FROM nvv_annotations WHERE audio IS NOT NULL)"


_LINES = r'intervals \[\d+\]:?\s*xmin = ([-+0-9.eE]+)\s*xmax = ([-+0-9.eE]+)\s*text = "((?:[^"]|"")*)"'
GRID = rf"""{MEM}, grids AS (SELECT dataset, stem, file_id, string_split_regex(content, 'item \[\d+\]:')[2:] AS items FROM mem WHERE suffix = '.textgrid'),
item AS (SELECT dataset, stem, file_id, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS tier_ord FROM grids),
cut AS (SELECT * EXCLUDE (item), regexp_extract(item, 'name = "((?:[^"]|"")*)"', 1) AS tier, regexp_extract_all(item, '{_LINES}', 1) AS a, regexp_extract_all(item, '{_LINES}', 2) AS b, regexp_extract_all(item, '{_LINES}', 3) AS t,
  len(regexp_extract_all(item, 'intervals \[\d+\]')) AS said FROM item),
bad AS (SELECT file_id FROM grids WHERE len(items) = 0 UNION SELECT file_id FROM cut WHERE len(a) <> said),
scan AS (SELECT dataset, stem, file_id, tier_ord, tier, unnest(range(0, len(a))) AS ord, CAST(unnest(a) AS DOUBLE) AS xmin, CAST(unnest(b) AS DOUBLE) AS xmax, replace(unnest(t), '""', '"') AS text
  FROM cut WHERE file_id NOT IN (SELECT file_id FROM bad))"""


@query(f"WITH {GRID} SELECT dataset, stem, file_id, CAST(tier_ord AS INTEGER) AS tier_ord, tier, CAST(ord AS INTEGER) AS ord, xmin, xmax, text FROM scan")
def a1_textgrid_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Intervals of all TextGrids in the store."""
    grids = files(spark, sf).where("suffix = '.textgrid'")
    return tg.interval_rows(grids, ["dataset", "stem", "file_id"])


@query(f"WITH {GRID} SELECT dataset, stem, file_id, 'no tiers, or an interval without bounds' AS error FROM grids WHERE file_id IN (SELECT file_id FROM bad)")
def a1_unreadable(spark: SparkSession, sf: str) -> DataFrame:
    """TextGrids that can't be read."""
    return tg.unreadable(files(spark, sf).where("suffix = '.textgrid'"), ["dataset", "stem", "file_id"])


@query(f"WITH {GRID} SELECT file_id, CAST(row_number() OVER (PARTITION BY file_id ORDER BY tier_ord, ord) - 1 AS INTEGER) AS ord, xmin, xmax, text FROM scan")
def a2_flat_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Intervals of all tiers of each TextGrid in one list, without tier."""
    place = F.row_number().over(Window.partitionBy("file_id").orderBy("tier_ord", "ord")) - 1
    return a1_textgrid_scan(spark, sf).select("file_id", place.alias("ord"), "xmin", "xmax", "text")


@query(
    f"""WITH {GRID}, ranked AS (SELECT *, dense_rank() OVER (PARTITION BY file_id ORDER BY tier_ord) AS k FROM scan),
w AS (SELECT * FROM ranked WHERE k = 1 AND NOT {q.silence('text')}), p AS (SELECT * FROM ranked WHERE k = 2 AND NOT {q.silence('text')}),
m AS (SELECT w.file_id, w.ord, row_number() OVER (PARTITION BY p.file_id, p.ord ORDER BY w.xmin, w.ord) AS r FROM w JOIN p USING (file_id) WHERE p.xmin < w.xmax - 0.001 AND p.xmax > w.xmin + 0.001),
n AS (SELECT file_id, ord, count(*) AS n FROM m WHERE r = 1 GROUP BY 1, 2)
SELECT file_id, CAST(ord AS INTEGER) AS ord, text AS word, CAST(coalesce(n, 0) AS INTEGER) AS phones FROM w LEFT JOIN n USING (file_id, ord)"""
)
def a3_words_with_phones(spark: SparkSession, sf: str) -> DataFrame:
    """Words of all TextGrids with what stands under them in the next tier."""
    out = tg.words_with_phones(a1_textgrid_scan(spark, sf), ["file_id"])
    return out.select("file_id", "ord", "word", F.size(F.coalesce("phones", F.array())).alias("phones"))


@query(
    rf"""WITH {MEM}, l AS (SELECT file_id, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS n FROM mem WHERE suffix = '_tokens.jsonl'),
k AS (SELECT file_id, line, row_number() OVER (PARTITION BY file_id ORDER BY n) - 1 AS ord FROM l WHERE trim(line) <> '')
SELECT file_id, CAST(ord AS INTEGER) AS ord, CASE WHEN json_valid(line) THEN json_extract_string(line, '$.word') END AS word, CASE WHEN json_valid(line) THEN CAST(json_extract(line, '$.start_s') AS DOUBLE) END AS start_s,
  CASE WHEN json_valid(line) THEN CAST(json_extract(line, '$.end_ms') AS DOUBLE) END AS end_ms FROM k WHERE json_valid(line)"""
)
def a4_token_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of all token files whose line is whole."""
    return six.token_lines(files(spark, sf)).where("not broken").select("file_id", "ord", "word", "start_s", "end_ms")


@query(
    rf"""WITH {MEM}, a AS (SELECT file_id, CAST(json_extract(content, '$[*]') AS JSON[]) AS js FROM mem WHERE suffix = '_punct.json' AND json_valid(content) AND content <> ''),
e AS (SELECT file_id, unnest(js) AS j, generate_subscripts(js, 1) - 1 AS ord FROM a)
SELECT file_id, CAST(ord AS INTEGER) AS ord, json_extract_string(j, '$.word') AS word, CAST(json_extract(j, '$.start_s') AS DOUBLE) AS start_s, CAST(json_extract(j, '$.end_s') AS DOUBLE) AS end_s FROM e"""
)
def a5_punct_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Anchors of all punctuation files that are whole."""
    whole = files(spark, sf).where(F.col("content").endswith("]"))
    return six.punct_entries(whole).select("file_id", "ord", "word", "start_s", "end_s")


@query(
    rf"""WITH {MEM}, r AS (SELECT dataset, stem, suffix, content, row_number() OVER (PARTITION BY dataset, stem ORDER BY list_position(['_text_cn.txt', '_text_raw.txt', '.lab'], suffix), file_id) AS n
FROM mem WHERE suffix IN ('_text_cn.txt', '_text_raw.txt', '.lab') AND content <> '') SELECT dataset, stem, suffix, content FROM r WHERE n = 1"""
)
def a6_text_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Each utterance's text by the chain clean, raw, tokens."""
    return six.first_of_chain(files(spark, sf), ["_text_cn.txt", "_text_raw.txt", ".lab"])


@query(
    rf"""WITH {MEM}, s AS (SELECT *, bool_or(layout = 'flat') OVER (PARTITION BY dataset, suffix) AS any_flat FROM mem)
SELECT dataset, suffix, stem, min(file_id) AS file_id FROM s WHERE layout = 'flat' OR NOT any_flat GROUP BY 1, 2, 3"""
)
def a8_file_index(spark: SparkSession, sf: str) -> DataFrame:
    """First file of each stem by suffix; nested ones where there are no flat ones."""
    return six.file_index(files(spark, sf))


@query(
    rf"""WITH {AUD}, w AS (SELECT DISTINCT name AS dataset, u.stem AS stem FROM batch_missing_v3, unnest(stems) AS u(stem) WHERE u.stem IS NOT NULL),
c AS (SELECT w.dataset, w.stem, 1 AS rule, a.stem AS audio_stem FROM w JOIN aud a ON a.dataset = w.dataset AND a.stem = w.stem
 UNION ALL SELECT w.dataset, w.stem, p.n - 3, a.stem FROM w, (VALUES (5), (6), (7), (8)) AS p(n), aud a WHERE regexp_matches(w.stem, '^\d+$') AND length(w.stem) <= p.n AND a.dataset = w.dataset AND a.stem = lpad(w.stem, p.n, '0')
 UNION ALL SELECT w.dataset, w.stem, 9, a.stem FROM w JOIN aud a ON a.dataset = w.dataset WHERE regexp_extract(w.stem, '(\d+)$', 1) <> '' AND regexp_extract(a.stem, '(\d+)$', 1) = regexp_extract(w.stem, '(\d+)$', 1)),
r AS (SELECT *, row_number() OVER (PARTITION BY dataset, stem ORDER BY rule, audio_stem) AS n FROM c)
SELECT dataset, stem, CAST(rule AS INTEGER) AS rule, audio_stem FROM r WHERE n = 1"""
)
def a9_wav_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Audio of the stems to be filled in, by ranked rules."""
    want = table(spark, sf, "batch_missing_v3").select(F.col("name").alias("dataset"), F.explode("stems").alias("stem")).where("stem is not null")
    return six.wav_candidates(want, six.audio_names(table(spark, sf, "nvv_annotations")))


_COMPLETE = rf"""{MEM}, {AUD}, audl AS (SELECT DISTINCT lower(dataset) AS dataset, lower(stem) AS stem FROM aud),
l AS (SELECT dataset, stem, layout, count(DISTINCT suffix) AS n, bool_or(suffix = '.lab') AS lab FROM mem GROUP BY 1, 2, 3),
own AS (SELECT dataset, stem, min(layout) AS layout, arg_min(n, layout) AS n FROM l WHERE lab GROUP BY 1, 2),
every AS (SELECT dataset, stem, count(DISTINCT suffix) AS n FROM mem GROUP BY 1, 2)"""


def _audio(spark: SparkSession, sf: str) -> DataFrame:
    names = six.audio_names(table(spark, sf, "nvv_annotations"))
    return names.select(F.lower("dataset").alias("dataset"), F.lower("stem").alias("stem")).distinct()


@query(f"WITH {_COMPLETE} SELECT own.dataset, own.stem, own.layout, own.n = 6 AS complete FROM own JOIN audl USING (dataset, stem)")
def a10_completeness(spark: SparkSession, sf: str) -> DataFrame:
    """Stems with audio and whether their layout holds all six members."""
    return six.completeness(files(spark, sf), _audio(spark, sf))


@query(f"WITH {_COMPLETE} SELECT dataset, count(*) FILTER (own.n = 6) AS complete, count(*) FILTER (own.n < 6) AS incomplete FROM own JOIN audl USING (dataset, stem) GROUP BY 1")
def a11_split(spark: SparkSession, sf: str) -> DataFrame:
    """Complete and incomplete stems by data set."""
    return a10_completeness(spark, sf).groupBy("dataset").agg(F.count_if("complete").alias("complete"), F.count_if(~F.col("complete")).alias("incomplete"))


@query(f"WITH {_COMPLETE} SELECT own.dataset, own.stem, own.layout, every.n = 6 AS complete FROM own JOIN audl USING (dataset, stem) JOIN every USING (dataset, stem)")
def a12_link_discovery(spark: SparkSession, sf: str) -> DataFrame:
    """The looser check: members in either layout."""
    return six.completeness(files(spark, sf), _audio(spark, sf), one_layout=False)


@query("SELECT token, array_to_string(arg_max(phones, line_no), ' ') AS phones FROM lexicon WHERE token IS NOT NULL GROUP BY 1")
def a13_lexicon_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The lexicon read from its lines, the last of a token's lines counting."""
    lines = table(spark, sf, "lexicon").select("line_no", F.concat_ws(" ", "token", F.array_join("phones", "  ")).alias("value"))
    from tessella.functions.lexicon import last_entries

    return last_entries(six.lexicon_lines(lines)).select("token", F.array_join("phones", " ").alias("phones"))


def _seconds(c: str) -> str:
    return f"rtrim(rtrim(CAST(round(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38, 20)), 6) AS DECIMAL(38, 6))::VARCHAR, '0'), '.')"


_WRITTEN = f"""{q.IV}, o AS (SELECT *, list_position(['raw_text', 'pinyin', 'hanzi', 'words', 'pinyin_phones'], tier) AS k, row_number() OVER (PARTITION BY dataset, stem, tier ORDER BY xmin, xmax, interval_id) AS i
  FROM iv WHERE tier IN ('raw_text', 'pinyin', 'hanzi', 'words', 'pinyin_phones'))"""


@query(
    rf"""WITH {_WRITTEN}, t AS (SELECT dataset, stem, tier, k, min(xmin) AS t0, max(xmax) AS t1, count(*) AS n,
  string_agg('        intervals [' || i || E']:\n            xmin = ' || {_seconds('xmin')} || E'\n            xmax = ' || {_seconds('xmax')} || E'\n            text = "' || replace(coalesce(text, ''), '"', '""') || E'"\n', '' ORDER BY i) AS rows FROM o GROUP BY 1, 2, 3, 4),
u AS (SELECT *, row_number() OVER (PARTITION BY dataset, stem ORDER BY k) AS j FROM t)
SELECT dataset, stem, E'File type = "ooTextFile"\nObject class = "TextGrid"\n\nxmin = ' || {_seconds('min(t0)')} || E'\nxmax = ' || {_seconds('max(t1)')} || E'\ntiers? <exists>\nsize = ' || count(*) || E'\nitem []:\n' ||
  string_agg('    item [' || j || E']:\n        class = "IntervalTier"\n        name = "' || tier || E'"\n        xmin = ' || {_seconds('t0')} || E'\n        xmax = ' || {_seconds('t1')} || E'\n        intervals: size = ' || n || E'\n' || rows, '' ORDER BY j) AS content
FROM u GROUP BY 1, 2"""
)
def a14_rendered(spark: SparkSession, sf: str) -> DataFrame:
    """Every utterance's tiers as the text of a TextGrid."""
    rows = iv.ordered_tiers(tiers(spark, sf)).withColumn("ord", F.row_number().over(iv.by_time(*UTT, "tier")) - 1)
    return tg.rendered(rows, UTT)


@query(f"WITH {_WRITTEN} SELECT dataset, stem, tier, count(*) AS n, CAST(sum({q.micros('xmax')} - {q.micros('xmin')}) AS BIGINT) AS micros FROM o GROUP BY 1, 2, 3")
def a14_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Intervals of the rendered TextGrids, read again: as many and as long as those written."""
    again = tg.interval_rows(a14_rendered(spark, sf), UTT)
    return again.groupBy(*UTT, "tier").agg(F.count(F.lit(1)).alias("n"), F.sum(tg.micros(F.col("xmax")) - tg.micros(F.col("xmin"))).alias("micros"))


_LAYOUT = ["%.lab", "%.TextGrid", "%\\_tokens.jsonl", "%\\_punct.json", "%\\_text\\_cn.txt", "%\\_text\\_raw.txt", "%/wavs/%", "%.wav"]


@query("SELECT pattern, count(f.file_id) AS files FROM (VALUES " + ", ".join(f"('{p}')" for p in _LAYOUT) + r") AS p(pattern) LEFT JOIN ctc_file f ON f.path LIKE p.pattern ESCAPE '\' GROUP BY 1")
def a22_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Files of the store by the patterns that its layout wants."""
    return six.layout_counts(table(spark, sf, "ctc_file"), _LAYOUT)


@query(f"WITH {MEM}, {AUD}, g AS (SELECT dataset, count(DISTINCT stem) AS textgrids FROM mem WHERE suffix = '.textgrid' GROUP BY 1), w AS (SELECT lower(dataset) AS dataset, count(DISTINCT stem) AS wavs FROM aud GROUP BY 1) SELECT dataset, coalesce(textgrids, 0) AS textgrids, wavs, coalesce(textgrids, 0) >= wavs AS done FROM w LEFT JOIN g USING (dataset)")
def a24_speaker_counts(spark: SparkSession, sf: str) -> DataFrame:
    """TextGrids and recordings by speaker folder."""
    return six.speaker_counts(files(spark, sf), six.audio_names(table(spark, sf, "nvv_annotations")))


# K


@query(
    rf"""WITH {q.IV}, h AS (SELECT dataset, stem, unnest(list_filter(regexp_split_to_array(regexp_replace(text, '<sp[0-9]>', ' ', 'g'), '[^\p{{L}}\p{{N}}_]+'), lambda x: regexp_matches(x, '^[a-z]+[1-5]$'))) AS hit FROM iv WHERE tier = 'raw_text' AND text IS NOT NULL)
SELECT dataset, stem, string_agg(DISTINCT hit, ' ' ORDER BY hit) AS hits FROM h GROUP BY 1, 2"""
)
def k1_pinyin_in_text(spark: SparkSession, sf: str) -> DataFrame:
    """Pinyin syllables left in raw texts."""
    return qc.pinyin_in_text(tiers(spark, sf, "raw_text")).select(*UTT, F.array_join("hits", " ").alias("hits"))


@query(f"WITH {q.IV}, u AS (SELECT DISTINCT dataset, stem FROM iv), t(tier, n) AS (VALUES ('raw_text', 1), ('pinyin', 2), ('hanzi', 3), ('words', 4), ('pinyin_phones', 5)) SELECT u.dataset, u.stem, string_agg(t.tier, ' ' ORDER BY t.n) AS missing FROM u CROSS JOIN t LEFT JOIN (SELECT DISTINCT dataset, stem, tier FROM iv) i ON i.dataset = u.dataset AND i.stem = u.stem AND i.tier = t.tier WHERE i.tier IS NULL GROUP BY 1, 2")
def k2_incomplete_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """Utterances without one of the five tiers."""
    return qc.incomplete_tiers(tiers(spark, sf)).select(*UTT, F.array_join("missing", " ").alias("missing"))


@query(
    f"""WITH {q.IV}, h AS (SELECT dataset, stem, row_number() OVER ({q.W}) AS i, {q.strip('text')} AS h FROM iv WHERE tier = 'hanzi' AND NOT {q.silence('text')}),
w AS (SELECT dataset, stem, row_number() OVER ({q.W}) AS i, {q.strip('text')} AS w FROM iv WHERE tier = 'words' AND NOT {q.silence('text')}),
b AS (SELECT dataset, stem, CASE WHEN h IS NULL OR w IS NULL THEN 1 WHEN regexp_matches(h, '^[一-鿿]') THEN CASE WHEN {q.pinyin('w')} THEN 0 ELSE 1 END
  WHEN regexp_matches(h, '^[A-Za-z]+$') THEN CASE WHEN regexp_replace(lower(w), '[012]+$', '') <> regexp_replace(lower(h), '[012]+$', '') THEN 1 ELSE 0 END ELSE 0 END AS x FROM h FULL JOIN w USING (dataset, stem, i)),
s AS (SELECT dataset, stem, CAST(sum(x) AS BIGINT) AS mismatches, count(*) AS total FROM b GROUP BY 1, 2)
SELECT * FROM s WHERE mismatches > 0.10 * total"""
)
def k3_tier_desync(spark: SparkSession, sf: str) -> DataFrame:
    """Utterances whose hanzi and words drift apart."""
    return qc.tier_desync(tiers(spark, sf, "hanzi", "words"))


@query(
    f"""WITH {q.IV}, p AS (SELECT * FROM iv WHERE tier = 'pinyin_phones' AND NOT {q.silence('text')}), w AS (SELECT * FROM iv WHERE tier = 'words' AND NOT {q.silence('text')}),
x AS (SELECT p.dataset, p.stem, NOT EXISTS (SELECT 1 FROM w WHERE w.dataset = p.dataset AND w.stem = p.stem AND p.xmin >= w.xmin - 0.05 AND p.xmax <= w.xmax + 0.05) AS o FROM p),
s AS (SELECT dataset, stem, count(*) FILTER (o) AS outside, count(*) AS total FROM x GROUP BY 1, 2) SELECT * FROM s WHERE outside > 0.15 * total"""
)
def k4_misaligned_phones(spark: SparkSession, sf: str) -> DataFrame:
    """Utterances with phones outside every word."""
    return qc.misaligned_phones(tiers(spark, sf, "words", "pinyin_phones"))


_SP3 = f"WITH {q.IV} SELECT interval_id, dataset, stem FROM iv WHERE tier = 'words' AND {q.strip('text')} = '<sp3>'"


@query(f"WITH {q.IV} SELECT interval_id, dataset, stem FROM iv WHERE tier = 'words' AND (({q.silence('text')} AND xmax - xmin >= 1.5) OR (NOT {q.silence('text')} AND {q.strip('text')} = '<sp3>'))")
def k5_long_silences(spark: SparkSession, sf: str) -> DataFrame:
    """Silences of the longest grade, once they are graded."""
    return qc.long_silences(iv.relabelled(tiers(spark, sf, "words")))


@query(f"WITH {q.IV}, n AS (SELECT *, row_number() OVER ({q.WT}) AS i FROM iv WHERE tier = 'words') SELECT dataset, stem, count(*) AS n FROM n WHERE i > 1 AND {q.silence('text')} AND {q.strip('text')} <> '' GROUP BY 1, 2")
def k6_middle_silences(spark: SparkSession, sf: str) -> DataFrame:
    """Silences after the first interval."""
    return qc.middle_silences(tiers(spark, sf, "words"))


@query(
    f"""WITH {q.IV}, w AS (SELECT * FROM iv WHERE tier = 'words' AND NOT {q.silence('text')}), p AS (SELECT * FROM iv WHERE tier = 'pinyin_phones' AND NOT {q.silence('text')}),
j AS (SELECT p.*, EXISTS (SELECT 1 FROM w WHERE {q.english('w.text')} AND w.dataset = p.dataset AND w.stem = p.stem AND p.xmin >= w.xmin - 0.005 AND p.xmax <= w.xmax + 0.005) AS en FROM p
  WHERE NOT EXISTS (SELECT 1 FROM w WHERE {q.vocal('w.text')} AND w.dataset = p.dataset AND w.stem = p.stem AND p.xmin >= w.xmin - 0.005 AND p.xmax <= w.xmax + 0.005))
SELECT interval_id, 'short_phone_en' AS rule FROM j WHERE en AND xmax - xmin < 0.010 UNION ALL SELECT interval_id, 'short_phone' FROM j WHERE NOT en AND xmax - xmin < 0.015
UNION ALL SELECT interval_id, 'long_vowel_en' FROM j WHERE en AND xmax - xmin > 0.5 AND regexp_replace(replace(text, 'en:', ''), '[012]+$', '') IN ({q.names(tk.ENGLISH_VOWELS)})
UNION ALL SELECT interval_id, 'long_consonant_en' FROM j WHERE en AND xmax - xmin > 1.0 AND regexp_replace(replace(text, 'en:', ''), '[012]+$', '') IN ({q.names(tk.ENGLISH_CONSONANTS)})"""
)
def k10_phone_durations(spark: SparkSession, sf: str) -> DataFrame:
    """Phones too short or too long."""
    return qc.phone_durations(tiers(spark, sf, "words", "pinyin_phones")).select("interval_id", "rule")


@query(
    f"""WITH {q.IV}, w AS (SELECT * FROM iv WHERE tier = 'words' AND {q.english('text')} AND xmax - xmin >= 0.02), p AS (SELECT * FROM iv WHERE tier = 'pinyin_phones' AND starts_with(text, 'en:')),
s AS (SELECT w.interval_id, coalesce(sum(p.xmax - p.xmin), 0) / any_value(w.xmax - w.xmin) AS share FROM w LEFT JOIN p ON w.dataset = p.dataset AND w.stem = p.stem AND p.xmin >= w.xmin - 0.002 AND p.xmax <= w.xmax + 0.002 GROUP BY w.dataset, w.stem, w.interval_id)
SELECT interval_id, share FROM s WHERE share < 0.25"""
)
def k11_low_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """English words that their phones hardly cover."""
    return qc.low_coverage(tiers(spark, sf, "words", "pinyin_phones")).select("interval_id", "share")


@query(
    rf"""WITH {q.IV}, r AS (SELECT dataset, stem, regexp_replace((array_agg(text ORDER BY xmin, xmax, interval_id))[1], '[^㐀-䶿一-鿿]', '', 'g') AS r FROM iv WHERE tier = 'raw_text' AND text IS NOT NULL GROUP BY 1, 2),
h AS (SELECT dataset, stem, string_agg({q.strip('text')}, '' ORDER BY xmin, xmax, interval_id) AS h FROM iv WHERE tier = 'hanzi' AND regexp_matches(text, '^\s*[㐀-䶿一-鿿]') GROUP BY 1, 2)
SELECT dataset, stem, CAST(length(r) AS INTEGER) AS raw_count, CAST(length(h) AS INTEGER) AS hanzi_count, CAST(length(r) - length(h) AS INTEGER) AS delta FROM r JOIN h USING (dataset, stem) WHERE r <> h"""
)
def k12_ideograph_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    """Utterances whose raw text and hanzi differ in ideographs."""
    return qc.ideograph_mismatch(tiers(spark, sf, "raw_text", "hanzi").where("text is not null"))


def _statuses(spark: SparkSession, sf: str) -> DataFrame:
    rows = tiers(spark, sf)
    return qc.routed(rows, qc.reasons(rows, heard(spark, sf)))


def _reasons_sql() -> str:
    parts = ("k1_pinyin_in_text", "k2_incomplete_tiers", "k3_tier_desync", "k4_misaligned_phones", "k5_long_silences", "k6_middle_silences", "d3_unexpected_silences", "k8_background_suspects")
    said = ("pinyin_in_text", "incomplete_tiers", "tier_desync", "misaligned_phones", "sp3", "mid_sp", "unexpected_silence", "bgm_suspect")
    return " UNION ALL ".join(f"SELECT dataset, stem, {i} AS rank, '{r}' AS reason FROM ({_SP3 if r == 'sp3' else SQL[p]})" for i, (p, r) in enumerate(zip(parts, said, strict=True)))


STATUS = (
    f"reasons AS ({_reasons_sql()}), listed AS (SELECT dataset, stem, string_agg(reason, '_' ORDER BY rank) AS rs FROM reasons GROUP BY 1, 2), "
    "kinds AS (SELECT dataset, stem, string_agg(reason, ',' ORDER BY rank) AS ds FROM (SELECT DISTINCT dataset, stem, rank, reason FROM reasons) GROUP BY 1, 2), "
    "every AS (SELECT DISTINCT dataset, stem FROM tier_interval WHERE xmin IS NOT NULL AND xmax IS NOT NULL), "
    "statuses AS (SELECT dataset, stem, coalesce('filtered_' || rs, 'ok') AS status, coalesce(ds, '') AS distinct_reasons FROM every LEFT JOIN listed USING (dataset, stem) LEFT JOIN kinds USING (dataset, stem))"
)


@query(f"WITH {STATUS} SELECT * FROM statuses")
def k13_routing(spark: SparkSession, sf: str) -> DataFrame:
    """Every utterance's status with its reasons."""
    return _statuses(spark, sf)


@query(f"WITH {STATUS} SELECT status = 'ok' AS ok, distinct_reasons, count(*) AS n FROM statuses GROUP BY 1, 2")
def a17_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Utterances by whether they pass, and by distinct reasons."""
    return _statuses(spark, sf).groupBy((F.col("status") == "ok").alias("ok"), "distinct_reasons").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {STATUS}, s AS (SELECT dataset, count(*) AS utterances, count(*) FILTER (status <> 'ok') AS filtered FROM statuses GROUP BY 1) SELECT *, filtered / utterances AS rate FROM s WHERE filtered / utterances > 0.05")
def k18_filter_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Data sets of which more than a twentieth is filtered."""
    return qc.filter_rates(_statuses(spark, sf))


@query(
    rf"""WITH {RAW}, u AS (SELECT DISTINCT ann_id, dataset, stem FROM nvv_annotations), c AS (SELECT u.dataset, u.stem, min(ann_id) AS ann_id FROM raw JOIN u USING (ann_id) GROUP BY 1, 2),
w AS (SELECT dataset, stem, unnest(regexp_extract_all(regexp_replace(regexp_replace(t, '<\|[^|]+\|>', ' ', 'g'), '\[[A-Za-z][^\]]*?\]', '', 'g'), '[A-Za-z]+')) AS token FROM c JOIN raw USING (ann_id)),
a AS (SELECT dataset, stem, lower(token) AS token, count(*) AS wanted FROM w GROUP BY 1, 2, 3), {q.TOK}, b AS (SELECT dataset, stem, lower(text) AS token, count(*) AS found FROM tok GROUP BY 1, 2, 3)
SELECT dataset, stem, token, wanted, coalesce(found, 0) AS found FROM a LEFT JOIN b USING (dataset, stem, token) WHERE wanted > coalesce(found, 0)"""
)
def k16_missing_multiset(spark: SparkSession, sf: str) -> DataFrame:
    """English words of the text that the tokens hold less often."""
    own = table(spark, sf, "nvv_annotations").select("ann_id", *UTT).distinct()
    first = raw_texts(spark, sf).join(own, "ann_id").groupBy(*UTT).agg(F.min_by("t", "ann_id").alias("t"))
    bare = F.regexp_replace(F.regexp_replace("t", r"<\|[^|]+\|>", " "), r"\[[A-Za-z][^\]]*?\]", "")
    words = F.transform(F.regexp_extract_all(bare, F.lit("([A-Za-z]+)"), F.lit(1)), F.lower)
    wanted = first.select(*UTT, F.explode(words).alias("token"))
    return qc.missing_multiset(wanted, token_rows(spark, sf).select(*UTT, F.lower("text").alias("token")))


@query(
    "WITH one AS (SELECT DISTINCT ON (ann_id) * FROM nvv_annotations ORDER BY ann_id, annotated_at DESC), e AS (SELECT ann_id, unnest(nvv_events).type AS type FROM one) "
    "SELECT type, count(*) AS n, count(DISTINCT ann_id) AS files FROM e WHERE type IS NOT NULL GROUP BY 1"
)
def k17_event_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Event types with their number and the annotations that have them."""
    one = table(spark, sf, "nvv_annotations").groupBy("ann_id").agg(F.max_by("nvv_events", "annotated_at").alias("es"))
    events = one.select("ann_id", F.explode("es.type").alias("type")).where("type is not null")
    return events.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("ann_id").alias("files"))
