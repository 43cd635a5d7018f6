"""Queries over interval tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import tokens as tk
from tessella.operators import intervals as iv
from tessella.plans import sqltext as q
from tessella.queries import query
from tessella.session import table

UTT = list(iv.UTT)


def tiers(spark: SparkSession, sf: str, *names: str, bounded: bool = True) -> DataFrame:
    return iv.tiers(table(spark, sf, "tier_interval"), *names, bounded=bounded)


def anchors(spark: SparkSession, sf: str, name: str, id_col: str) -> DataFrame:
    """Tokens or anchors as intervals, each id once; ends may be missing."""
    rows = table(spark, sf, name).where("start_s is not null")
    return rows.select(F.col(id_col).alias("interval_id"), *UTT, F.col("start_s").alias("xmin"), F.col("end_s").alias("xmax"), F.col("word").alias("text")).repartition(*UTT).distinct()


def ended_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All tokens and punctuation anchors by ``kind``; those delivered without end get one."""
    kinds = (("token", "ctc_token", "token_id"), ("punct", "ctc_punct", "punct_id"))
    tokens, punct = (anchors(spark, sf, name, key).withColumn("kind", F.lit(kind)) for kind, name, key in kinds)
    return iv.ended(tokens.unionByName(punct))


def token_rows(spark: SparkSession, sf: str) -> DataFrame:
    return ended_rows(spark, sf).where("kind = 'token'").select("interval_id", *UTT, "xmin", "xmax", "text")


def punct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return ended_rows(spark, sf).where("kind = 'punct'").select("interval_id", *UTT, "xmin", "xmax", "text")


def utterances(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "utterance").groupBy(*UTT).agg(F.max("xmax").alias("xmax"))


# B


@query(f"WITH {q.IV} SELECT {q.grade('xmax - xmin')} AS grade, count(*) AS n, min(xmax - xmin) AS shortest, max(xmax - xmin) AS longest FROM iv WHERE tier = 'words' AND {q.silence('text')} AND xmax >= xmin GROUP BY 1")
def b1_silence_grade(spark: SparkSession, sf: str) -> DataFrame:
    """Silences of the words tier by grade."""
    rows = tiers(spark, sf, "words").where(tk.is_silence(F.col("text")) & (F.col("xmax") >= F.col("xmin")))
    d = iv.duration()
    return rows.groupBy(tk.silence_grade(d).alias("grade")).agg(F.count(F.lit(1)).alias("n"), F.min(d).alias("shortest"), F.max(d).alias("longest"))


@query(f"WITH {q.IV} SELECT interval_id, CASE WHEN {q.silence('text')} THEN {q.grade('xmax - xmin')} ELSE text END AS text FROM iv")
def b2_relabel_silences(spark: SparkSession, sf: str) -> DataFrame:
    """Every tier with its silences graded."""
    return iv.relabelled(tiers(spark, sf)).select("interval_id", "text")


@query(f"WITH {q.IV} SELECT interval_id, tier FROM iv WHERE xmax > xmin + 0.001")
def b3_tombstones(spark: SparkSession, sf: str) -> DataFrame:
    """Intervals that are no tombstones."""
    return iv.without_tombstones(tiers(spark, sf)).select("interval_id", "tier")


@query(f"WITH {q.IV} SELECT interval_id, tier FROM iv WHERE xmax - xmin > 0.001 OR {q.strip('text')} = ''")
def b4_zero_duration(spark: SparkSession, sf: str) -> DataFrame:
    """Intervals that last or are blank."""
    return iv.without_empty(tiers(spark, sf)).select("interval_id", "tier")


@query(f"WITH {q.IV} SELECT dataset, stem, count(*) AS n, min(xmin) AS xmin, max(xmax) AS xmax FROM iv WHERE tier = 'hanzi' GROUP BY 1, 2")
def b5_tier_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Extent of each utterance's tier of a name in any letter case."""
    return tiers(spark, sf, "hanzi").groupBy(*UTT).agg(F.count(F.lit(1)).alias("n"), F.min("xmin").alias("xmin"), F.max("xmax").alias("xmax"))


@query(
    f"WITH {q.IV}, {q.TOK}, lx AS (SELECT lower(token) AS low, arg_min(token, line_no) AS token FROM lexicon GROUP BY 1), every AS (SELECT 'words' AS kind, interval_id, text FROM iv WHERE tier = 'words' UNION ALL SELECT 'token', interval_id, text FROM tok) "
    "SELECT kind, interval_id, text AS was, token AS text FROM every JOIN lx ON lower(text) = low WHERE token <> text"
)
def b6_canonical_case(spark: SparkSession, sf: str) -> DataFrame:
    """Words and tokens whose spelling the lexicon changes."""
    rows = tiers(spark, sf, "words").select("interval_id", "text", F.lit("words").alias("kind"))
    rows = rows.unionByName(token_rows(spark, sf).select("interval_id", "text", F.lit("token").alias("kind"))).withColumn("was", F.col("text"))
    return iv.canonical_case(rows, table(spark, sf, "lexicon")).where("text <> was").select("kind", "interval_id", "was", "text")


@query(
    f"""WITH {q.IV}, m AS (SELECT interval_id, dataset, stem, tier, xmin, xmax, array_to_string(list_transform(regexp_extract_all(text, '[A-Z-]+|[^A-Z-]+'), lambda x: CASE WHEN x IN ({q.names(tk.VOCALISATIONS)}) THEN '<' || x || '>' ELSE x END), '') AS text
  FROM iv WHERE tier IN ({q.names(iv.TIER_ORDER)})), o AS (SELECT *, row_number() OVER w AS place, regexp_matches(text, '^<sp[0-9]>') AS graded, sum(CASE WHEN regexp_matches(text, '^<sp[0-9]>') THEN 1 ELSE 0 END) OVER w AS seen FROM m WINDOW w AS ({q.WT}))
SELECT interval_id, tier, CASE WHEN tier = 'raw_text' AND place = 1 AND {q.strip('text')} <> '' AND NOT starts_with(text, '<sp') THEN '<sp1>' || text
  WHEN tier <> 'raw_text' AND graded AND seen = 1 THEN regexp_replace(text, '^<sp[0-9]>', '<sp1>') ELSE text END AS text FROM o"""
)
def b7_finalise(spark: SparkSession, sf: str) -> DataFrame:
    """All tiers with the last normalisation of labels."""
    return iv.finalised(tiers(spark, sf, *iv.TIER_ORDER)).select("interval_id", "tier", "text")


@query(
    f"WITH {q.IV} SELECT interval_id, CASE WHEN upper({q.strip('text')}) IN ({q.names(tk.VOCALISATIONS)}) THEN '<' || {q.strip('text')} || '>' "
    f"WHEN regexp_matches({q.strip('text')}, '^sp[0-9]$') THEN '<' || {q.strip('text')} || '>' ELSE text END AS text FROM iv WHERE tier IN ('words', 'hanzi', 'pinyin_phones')"
)
def b8_whole_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Whole-interval labels between angle brackets."""
    t = tk.stripped(F.col("text"))
    wrap = F.upper(t).isin(*tk.VOCALISATIONS) | t.rlike("^sp[0-9]$")
    return tiers(spark, sf, "words", "hanzi", "pinyin_phones").select("interval_id", F.when(wrap, F.concat(F.lit("<"), t, F.lit(">"))).otherwise(F.col("text")).alias("text"))


@query(
    f"WITH {q.IV} SELECT dataset, stem, tier, CAST(list_position(['raw_text', 'pinyin', 'hanzi', 'words', 'pinyin_phones'], tier) AS INTEGER) AS tier_ord, count(*) AS n "
    "FROM iv WHERE tier IN ('raw_text', 'pinyin', 'hanzi', 'words', 'pinyin_phones') GROUP BY 1, 2, 3, 4"
)
def b10_tier_order(spark: SparkSession, sf: str) -> DataFrame:
    """Tiers of each utterance in the order of writing."""
    return iv.ordered_tiers(tiers(spark, sf)).groupBy(*UTT, "tier", "tier_ord").agg(F.count(F.lit(1)).alias("n"))


# C

_VALID = "xmax > xmin"


@query(
    f"""WITH {q.IV}, w AS (SELECT * FROM iv WHERE tier = 'words' AND xmax > xmin), p AS (SELECT * FROM iv WHERE tier = 'pinyin_phones' AND xmax > xmin),
m AS (SELECT w.interval_id AS word_id, w.text AS word, p.interval_id AS part_id, p.text AS part, greatest(w.xmin, p.xmin) AS xmin, least(w.xmax, p.xmax) AS xmax,
  row_number() OVER (PARTITION BY p.dataset, p.stem, p.interval_id ORDER BY w.xmin, w.interval_id) AS r
  FROM w JOIN p USING (dataset, stem) WHERE p.xmin < w.xmax - 0.001 AND p.xmax > w.xmin + 0.001)
SELECT word_id, word, part_id, part, xmin, xmax FROM m WHERE r = 1"""
)
def c1_phones_in_words(spark: SparkSession, sf: str) -> DataFrame:
    """Phones of each word, clipped; a straddling phone goes to the earlier word only."""
    rows = tiers(spark, sf, "words", "pinyin_phones").where(_VALID)
    out = iv.parts_in_words(rows.where("tier = 'words'"), rows.where("tier = 'pinyin_phones'"))
    return out.select("word_id", "word", "part_id", "part", "xmin", "xmax")


_BEST = f"""{q.IV}, {q.TOK}, w AS (SELECT * FROM iv WHERE tier = 'words'),
best AS (SELECT w.dataset, w.stem, w.interval_id, w.xmin, w.xmax, w.text, t.interval_id AS anchor_id, t.text AS word,
  row_number() OVER (PARTITION BY w.dataset, w.stem, w.interval_id ORDER BY round(least(w.xmax, t.xmax) - greatest(w.xmin, t.xmin), 6) DESC, t.interval_id) AS r
  FROM w JOIN tok t USING (dataset, stem) WHERE w.xmax > t.xmin AND w.xmin < t.xmax)"""


def _anchored(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return tiers(spark, sf, "words"), token_rows(spark, sf).withColumnRenamed("text", "word")


@query(f"WITH {_BEST} SELECT interval_id, text, anchor_id, word FROM best WHERE r = 1")
def c3_best_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """The token that overlaps each word most."""
    return iv.best_overlap(*_anchored(spark, sf)).select("interval_id", "text", "anchor_id", "word")


@query(
    f"WITH {_BEST} SELECT interval_id, text, word AS restored FROM best WHERE r = 1 AND ((text = '<unk>') OR (regexp_matches(text, '^\\[.*\\]$') AND ({q.english('word')} OR {q.vocal('word')})) "
    f"OR ({q.pinyin('text')} AND {q.english('word')}))"
)
def c3_restored_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Words that take the label of their token."""
    return iv.restored_labels(*_anchored(spark, sf)).select("interval_id", "text", "restored")


@query(
    f"""WITH {_BEST}, e AS (SELECT * FROM best WHERE r = 1 AND {q.english('text')} AND {q.english('word')} AND lower(text) = lower(word)),
f AS (SELECT *, CASE WHEN anchor_id = lag(anchor_id) OVER ({q.W}) THEN 0 ELSE 1 END AS n FROM e),
g AS (SELECT *, sum(n) OVER ({q.W}) AS g FROM f)
SELECT dataset, stem, anchor_id, min(xmin) AS xmin, max(xmax) AS xmax, count(*) AS n FROM g GROUP BY dataset, stem, anchor_id, g"""
)
def c4_fragments(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbouring English words under one token as one."""
    rows, tokens = _anchored(spark, sf)
    best = iv.best_overlap(rows, tokens).select(*UTT, "interval_id", "anchor_id", "word")
    both = rows.join(best, [*UTT, "interval_id"]).where(tk.is_english(F.col("text")) & tk.is_english(F.col("word")) & (F.lower("text") == F.lower("word")))
    w = iv.by_time()
    marked = iv.islands(both, ~F.coalesce(F.col("anchor_id") == F.lag("anchor_id").over(w), F.lit(False)), w)
    return marked.groupBy(*UTT, "anchor_id", "island").agg(F.min("xmin").alias("xmin"), F.max("xmax").alias("xmax"), F.count(F.lit(1)).alias("n")).drop("island")


@query(
    f"""WITH {q.IV}, {q.TOK}, m AS (SELECT w.interval_id, t.interval_id AS entry_id, row_number() OVER (PARTITION BY w.dataset, w.stem, w.interval_id
  ORDER BY CASE WHEN floor(w.xmin / 0.5 + 0.5) = floor(t.xmin / 0.5 + 0.5) THEN 0 ELSE 1 END, t.xmin, t.interval_id) AS r
  FROM iv w JOIN tok t USING (dataset, stem) WHERE w.tier = 'words' AND {q.english('w.text')} AND lower(w.text) = lower(t.text) AND abs(w.xmin - t.xmin) < 1.0)
SELECT interval_id, entry_id FROM m WHERE r = 1"""
)
def c6_nearest_entry(spark: SparkSession, sf: str) -> DataFrame:
    """The entry of the same English word that starts nearest by."""
    rows, tokens = _anchored(spark, sf)
    return iv.nearest_entry(rows.where(tk.is_english(F.col("text"))), tokens).select("interval_id", "entry_id")


_VOCAL_RANGES = f"{q.IV}, p AS (SELECT * FROM iv WHERE tier = 'pinyin_phones'), v AS (SELECT * FROM iv WHERE tier = 'words' AND {q.vocal('text')})"


def _phones_and_vocals(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = tiers(spark, sf, "words", "pinyin_phones")
    return rows.where("tier = 'pinyin_phones'"), rows.where((F.col("tier") == "words") & tk.is_vocalisation(F.col("text")))


@query(f"WITH {_VOCAL_RANGES} SELECT interval_id, text FROM p WHERE EXISTS (SELECT 1 FROM v WHERE v.dataset = p.dataset AND v.stem = p.stem AND p.xmin >= v.xmin - 0.005 AND p.xmax <= v.xmax + 0.005)")
def c7_contained(spark: SparkSession, sf: str) -> DataFrame:
    """Phones within a vocalisation, give or take 5 ms."""
    return iv.within_any(*_phones_and_vocals(spark, sf), 0.005).select("interval_id", "text")


@query(
    f"""WITH {q.IV}, w AS (SELECT * FROM iv WHERE tier = 'words' AND xmax > xmin), p AS (SELECT * FROM iv WHERE tier = 'pinyin_phones')
SELECT w.interval_id, coalesce(sum(p.xmax - p.xmin), 0) / any_value(w.xmax - w.xmin) AS share FROM w LEFT JOIN p
  ON w.dataset = p.dataset AND w.stem = p.stem AND p.xmin >= w.xmin - 0.002 AND p.xmax <= w.xmax + 0.002 GROUP BY w.dataset, w.stem, w.interval_id"""
)
def c8_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Share of each word covered by its phones."""
    rows = tiers(spark, sf, "words", "pinyin_phones")
    return iv.covered_share(rows.where("tier = 'words'"), rows.where("tier = 'pinyin_phones'")).select("interval_id", "share")


@query(
    f"""WITH {q.PUN}, e AS (SELECT * FROM pun WHERE text = '…'), r AS (SELECT * FROM pun WHERE text <> '…')
SELECT interval_id, text FROM r UNION ALL SELECT interval_id, text FROM e WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.dataset = e.dataset AND r.stem = e.stem AND r.xmax > e.xmin AND r.xmin < e.xmax)"""
)
def c11_ellipses(spark: SparkSession, sf: str) -> DataFrame:
    """Punctuation anchors without ellipses that overlap a mark."""
    rows = punct_rows(spark, sf)
    marks = rows.where("text <> '…'")
    return marks.unionByName(iv.overlapping_none(rows.where("text = '…'"), marks)).select("interval_id", "text")


@query(f"WITH {_VOCAL_RANGES} SELECT interval_id, text FROM p WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.dataset = p.dataset AND v.stem = p.stem AND p.xmin >= v.xmin - 0.05 AND p.xmax <= v.xmax + 0.05)")
def c12_subtracted(spark: SparkSession, sf: str) -> DataFrame:
    """Phones that lie in no vocalisation."""
    return iv.outside_all(*_phones_and_vocals(spark, sf), 0.05).select("interval_id", "text")


# D


@query(
    f"""WITH {q.IV}, f AS (SELECT *, {q.silence('text')} AS sil, lag({q.silence('text')}) OVER ({q.WT}) AS psil, lag(interval_id) OVER ({q.WT}) AS pid FROM iv WHERE tier = 'pinyin_phones')
SELECT interval_id, pid AS into_id, xmax AS new_xmax FROM f WHERE sil AND xmax - xmin < 0.2 AND NOT psil"""
)
def d1_short_silences(spark: SparkSession, sf: str) -> DataFrame:
    """Short silences and the phone each is merged into."""
    return iv.short_silences(tiers(spark, sf, "pinyin_phones")).select("interval_id", "into_id", "new_xmax")


_SHORT = tuple(dict.fromkeys([*tk.SHORT_WORDS, *[s.rstrip("12345") for s in tk.SHORT_WORDS]]))


@query(
    f"""WITH {q.IV}, f AS (SELECT *, lead(xmin) OVER ({q.WT}) AS nmin, lead(xmax) OVER ({q.WT}) AS nmax, lead(text) OVER ({q.WT}) AS ntext FROM iv WHERE tier = 'words')
SELECT interval_id, text, nmax AS silence_end FROM f WHERE regexp_replace(text, '[0-9]+$', '') IN ({q.names(_SHORT)}) AND xmax - xmin < 0.25 AND {q.silence('ntext')} AND nmax - nmin >= 0.4"""
)
def d2_short_words(spark: SparkSession, sf: str) -> DataFrame:
    """Function words squeezed before a long silence."""
    return iv.short_words(tiers(spark, sf, "words")).select("interval_id", "text", "silence_end")


_GAPS = f"""{q.IV}, kinds AS (SELECT *, CASE WHEN {q.silence('text')} THEN 'silence' WHEN {q.punct('text')} THEN 'punct' ELSE 'word' END AS kind FROM iv WHERE tier = 'words'),
num AS (SELECT *, sum(CASE WHEN kind = 'word' THEN 1 ELSE 0 END) OVER ({q.W} ROWS UNBOUNDED PRECEDING) AS k FROM kinds),
gaps0 AS (SELECT dataset, stem, k, max(CASE WHEN kind = 'word' THEN text END) AS before, bool_or(kind = 'punct') AS has_punct,
  (array_agg({q.grade('xmax - xmin')} ORDER BY xmin, xmax, interval_id) FILTER (kind = 'silence'))[1] AS silence FROM num GROUP BY 1, 2, 3),
gaps AS (SELECT *, lead(before) OVER (PARTITION BY dataset, stem ORDER BY k) AS after FROM gaps0)"""


@query(
    f"WITH {_GAPS} SELECT dataset, stem, k, before, after, silence FROM gaps WHERE k >= 1 AND after IS NOT NULL AND silence IN ('<sp1>', '<sp2>', '<sp3>') AND NOT has_punct "
    f"AND NOT {q.english('before')} AND NOT {q.vocal('before')} AND NOT {q.english('after')} AND NOT {q.vocal('after')}"
)
def d3_unexpected_silences(spark: SparkSession, sf: str) -> DataFrame:
    """Pauses within sentences that no punctuation explains."""
    return iv.unexpected_silences(tiers(spark, sf, "words")).select(*UTT, "k", "before", "after", "silence")


@query(
    f"""WITH {_GAPS}, facts AS (SELECT *, bool_or(kind = 'silence') OVER g AS has_sil, bool_or(kind = 'punct') OVER g AS has_p, max(k) OVER (PARTITION BY dataset, stem) AS last_k FROM num WINDOW g AS (PARTITION BY dataset, stem, k)),
pieces AS (SELECT *, CASE WHEN kind = 'word' THEN text || CASE WHEN k >= 1 AND k < last_k AND has_sil AND NOT has_p THEN ' [sp]' ELSE '' END
  WHEN kind = 'punct' AND (has_sil OR k < 1 OR k >= last_k) THEN text END AS piece FROM facts)
SELECT dataset, stem, string_agg(piece, ' ' ORDER BY xmin, xmax, interval_id) AS text FROM pieces WHERE piece IS NOT NULL GROUP BY 1, 2"""
)
def d4_cross_checked(spark: SparkSession, sf: str) -> DataFrame:
    """Utterance texts with punctuation and pauses checked against each other."""
    return iv.cross_checked_text(tiers(spark, sf, "words"))


@query(
    f"""WITH {q.IV}, f AS (SELECT *, lead(xmin) OVER ({q.WT}) AS nmin, lead(text) OVER ({q.WT}) AS ntext, lead(interval_id) OVER ({q.WT}) AS nid, lead(xmax) OVER ({q.WT}) AS nmax FROM iv WHERE tier IN ('words', 'hanzi'))
SELECT interval_id, nid AS absorbed_id, nmax AS xmax FROM f WHERE {q.vocal('text')} AND ntext = '…' AND nmin - xmax < 0.02"""
)
def d5_vocal_ellipses(spark: SparkSession, sf: str) -> DataFrame:
    """Vocalisations and the ellipsis each absorbs."""
    return iv.vocal_ellipses(tiers(spark, sf, "words", "hanzi")).select("interval_id", "absorbed_id", "xmax")


@query(
    f"""WITH {q.IV}, f AS (SELECT *, CASE WHEN text = lag(text) OVER ({q.WT}) AND xmin - lag(xmax) OVER ({q.WT}) < 0.002 THEN 0 ELSE 1 END AS n FROM iv WHERE tier IN ('words', 'pinyin_phones') AND text IS NOT NULL),
g AS (SELECT *, sum(n) OVER ({q.WT}) AS g FROM f)
SELECT dataset, stem, tier, min(interval_id) AS first_id, min(xmin) AS xmin, max(xmax) AS xmax, min(text) AS text, count(*) AS n FROM g GROUP BY dataset, stem, tier, g"""
)
def d8_same_text(spark: SparkSession, sf: str) -> DataFrame:
    """Touching neighbours of one text as one interval."""
    return iv.same_text_merged(tiers(spark, sf, "words", "pinyin_phones").where("text is not null"))


def _runs_sql(keep: str, same: str) -> str:
    return f"""WITH {q.TOK}, f AS (SELECT *, {keep} AS keep, coalesce({keep} AND lag({keep}) OVER ({q.W}) AND {same}, false) AS cont FROM tok WHERE text IS NOT NULL),
g AS (SELECT *, sum(CASE WHEN cont THEN 0 ELSE 1 END) OVER ({q.W}) AS g FROM f)
SELECT dataset, stem, (array_agg(interval_id ORDER BY xmin, xmax, interval_id))[1] AS first_id, count(*) AS n, min(xmin) AS xmin, max(xmax) AS xmax, string_agg(text, '' ORDER BY xmin, xmax, interval_id) AS joined
FROM g WHERE keep GROUP BY dataset, stem, g HAVING count(*) > 1"""


@query(_runs_sql(q.vocal("text"), f"text = lag(text) OVER ({q.W})"))
def d10_vocal_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of one vocalisation."""
    return iv.label_runs(token_rows(spark, sf).where("text is not null"), tk.is_vocalisation(F.col("text"))).where("n > 1")


@query(_runs_sql("regexp_matches(text, '^[A-Za-z]+$')", "true"))
def d11_letter_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of tokens in letters only, joined."""
    return iv.label_runs(token_rows(spark, sf).where("text is not null"), F.col("text").rlike("^[A-Za-z]+$"), F.lit(True)).where("n > 1")


@query(
    f"""WITH {q.TOK}, f AS (SELECT *, lead(text) OVER ({q.W}) AS ntext, lead(interval_id) OVER ({q.W}) AS second_id, lead(xmax) OVER ({q.W}) AS nmax FROM tok)
SELECT interval_id, second_id, xmin, nmax AS xmax FROM f WHERE regexp_matches(text, '^rui[0-5]$') AND regexp_matches(ntext, '^y?a[0-5]$')"""
)
def d12_name_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Fragments of the name, to be one token."""
    return iv.name_pairs(token_rows(spark, sf)).select("interval_id", "second_id", "xmin", "xmax")


@query(
    f"""WITH {q.TOK}, {q.PUN}, items AS (SELECT *, 'token' AS kind FROM tok UNION ALL SELECT *, 'punct' FROM pun), u AS (SELECT *, CAST(round(xmin * 1000000) AS BIGINT) AS us FROM items)
SELECT kind, interval_id, coalesce(min(xmin) OVER (PARTITION BY dataset, stem ORDER BY us RANGE BETWEEN 1001 FOLLOWING AND UNBOUNDED FOLLOWING), xmax) AS new_xmax FROM u"""
)
def d13_next_start(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens and anchors, each ending where the next begins."""
    items = token_rows(spark, sf).withColumn("kind", F.lit("token")).unionByName(punct_rows(spark, sf).withColumn("kind", F.lit("punct")))
    return iv.next_start_ends(items).select("kind", "interval_id", "new_xmax")


@query(
    f"""WITH {q.TOK}, {q.UTT}, f AS (SELECT t.*, u.xmax AS utt_end, lead(t.xmin) OVER (PARTITION BY t.dataset, t.stem ORDER BY t.xmin, t.xmax, t.interval_id) AS nx,
  row_number() OVER (PARTITION BY t.dataset, t.stem ORDER BY t.xmin, t.xmax, t.interval_id) AS r FROM tok t JOIN utt u USING (dataset, stem)),
s AS (SELECT *, coalesce(nx, xmax) AS stop FROM f)
SELECT dataset, stem, 0.0 AS xmin, xmin AS xmax, '' AS text FROM s WHERE r = 1 AND xmin > 0.005 UNION ALL SELECT dataset, stem, xmin, stop, text FROM s
UNION ALL SELECT dataset, stem, stop, coalesce(nx, utt_end), '' FROM s WHERE coalesce(nx, utt_end) - stop > 0.005"""
)
def a15_gap_filled_tier(spark: SparkSession, sf: str) -> DataFrame:
    """The words tier rebuilt from tokens, gaps as empty intervals."""
    rows = token_rows(spark, sf).join(utterances(spark, sf).withColumnRenamed("xmax", "utt_end"), UTT)
    return iv.filled_gaps(rows)


@query(
    f"""WITH {q.TOK}, {q.PUN}, {q.UTT}, items AS (SELECT * FROM tok UNION ALL SELECT interval_id + 1000000000000, dataset, stem, xmin, xmax, text FROM pun),
f AS (SELECT t.*, u.xmax AS utt_end, lead(t.xmin) OVER (PARTITION BY t.dataset, t.stem ORDER BY t.xmin, t.xmax, t.interval_id) AS nx,
  row_number() OVER (PARTITION BY t.dataset, t.stem ORDER BY t.xmin, t.xmax, t.interval_id) AS r FROM items t JOIN utt u USING (dataset, stem)),
s AS (SELECT *, coalesce(nx, xmax) AS stop FROM f)
SELECT dataset, stem, 0.0 AS xmin, xmin AS xmax, '' AS text FROM s WHERE r = 1 AND xmin > 0.005 UNION ALL SELECT dataset, stem, xmin, stop, text FROM s
UNION ALL SELECT dataset, stem, stop, coalesce(nx, utt_end), '' FROM s WHERE coalesce(nx, utt_end) - stop > 0.005"""
)
def a16_rebuilt_tier(spark: SparkSession, sf: str) -> DataFrame:
    """The words tier rebuilt from tokens and punctuation anchors together."""
    both = token_rows(spark, sf).unionByName(punct_rows(spark, sf).withColumn("interval_id", F.col("interval_id") + 1_000_000_000_000))
    return iv.filled_gaps(both.join(utterances(spark, sf).withColumnRenamed("xmax", "utt_end"), UTT))


@query(
    f"""WITH {q.TOK}, e AS (SELECT * FROM tok WHERE {q.english('text')}), f AS (SELECT *, CASE WHEN xmin - lag(xmax) OVER ({q.W}) >= 0.35 OR lag(xmax) OVER ({q.W}) IS NULL THEN 1 ELSE 0 END AS n FROM e),
g AS (SELECT *, sum(n) OVER ({q.W}) AS segment FROM f)
SELECT dataset, stem, CAST(segment AS BIGINT) AS segment, min(xmin) AS xmin, (array_agg(xmax ORDER BY xmin DESC, interval_id DESC))[1] AS xmax, count(*) AS words, string_agg(text, ' ' ORDER BY xmin, xmax, interval_id) AS text FROM g GROUP BY 1, 2, 3"""
)
def j11_english_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Segments of English words closer than 0.35 s."""
    return iv.word_segments(token_rows(spark, sf))


@query(f"""WITH {q.TOK}, {q.UTT}, e AS (SELECT * FROM tok WHERE {q.english('text')}), f AS (SELECT *, CASE WHEN xmin - lag(xmax) OVER ({q.W}) >= 0.35 OR lag(xmax) OVER ({q.W}) IS NULL THEN 1 ELSE 0 END AS n FROM e),
g AS (SELECT *, sum(n) OVER ({q.W}) AS segment FROM f),
s AS (SELECT dataset, stem, CAST(segment AS BIGINT) AS segment, min(xmin) AS a, (array_agg(xmax ORDER BY xmin DESC, interval_id DESC))[1] AS b, count(*) AS words FROM g GROUP BY 1, 2, 3)
SELECT dataset, stem, segment, words, b - a < 0.2 AS fallback, CASE WHEN b - a >= 0.2 THEN greatest(0.0, a - 0.05) END AS "offset", CASE WHEN b - a >= 0.2 THEN least(u.xmax, b + 0.05) END AS stop FROM s JOIN utt u USING (dataset, stem)""")
def j12_padded_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Segments padded within their utterance, short ones as fallbacks."""
    return iv.padded_segments(iv.word_segments(token_rows(spark, sf)), utterances(spark, sf))


@query(f"WITH {q.IV} SELECT dataset, stem, tier, (array_agg(interval_id ORDER BY xmin, xmax, interval_id))[1] AS first_id, (array_agg(interval_id ORDER BY xmin DESC, xmax DESC, interval_id DESC))[1] AS last_id, count(*) AS n FROM iv GROUP BY 1, 2, 3")
def g5_first_last(spark: SparkSession, sf: str) -> DataFrame:
    """First and last interval of every tier."""
    return iv.first_last(tiers(spark, sf), *UTT, "tier")


@query(f"WITH {q.PUN} SELECT interval_id, CASE WHEN xmax <= xmin THEN xmin + 0.060 ELSE xmax END AS xmax FROM pun")
def e5_invalid_anchor(spark: SparkSession, sf: str) -> DataFrame:
    """Anchors that end before they start last 60 ms."""
    return punct_rows(spark, sf).select("interval_id", F.when(F.col("xmax") <= F.col("xmin"), F.col("xmin") + 0.060).otherwise(F.col("xmax")).alias("xmax"))


@query(f"WITH {q.TOK} SELECT text, count(*) AS n, {q.vocal('text')} AS vocal FROM tok WHERE regexp_matches(text, '^[A-Z][A-Z0-9-]*[A-Z0-9]$') GROUP BY 1, 3")
def e7_capital_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Capital labels, of which vocalisations are some."""
    rows = token_rows(spark, sf).where(tk.is_upper_label(F.col("text")))
    return rows.groupBy("text", tk.is_vocalisation(F.col("text")).alias("vocal")).agg(F.count(F.lit(1)).alias("n"))
