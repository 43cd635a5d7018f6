"""Queries over kernels: alignment, boundary adjustment, fusion, and framed signals."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import adjust, align, audio, fusion, signal
from tessella.plans import sqltext as q
from tessella.plans import pipeline, steps
from tessella.plans.interval_queries import UTT, ended_rows, tiers
from tessella.plans.record_queries import a10_completeness
from tessella.queries import query
from tessella.session import table
from tessella.sources import voices

def _rows(spark: SparkSession, sf: str) -> DataFrame:
    return tiers(spark, sf, "words", "pinyin_phones", "raw_text")


def assembled(spark: SparkSession, sf: str) -> DataFrame:
    """One row per utterance: its words, phones, tokens and anchors nested, and its text."""
    return steps.nested(_rows(spark, sf), ended_rows(spark, sf))


def used_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    return steps.used_entries(_rows(spark, sf), ended_rows(spark, sf), table(spark, sf, "lexicon"))


@query(
    f"""WITH RECURSIVE {q.IV}, {q.NESTED}, u AS (SELECT id, dataset, stem, list_transform(words, lambda w: lower(w.t)) AS a, list_transform(tokens, lambda t: lower(t)) AS b FROM ul WHERE tokens IS NOT NULL),
{q.alignment('{x} = {y}', True)}, p AS (SELECT id, count(*) FILTER (step = 0 AND a[i + 1] = b[j + 1]) AS pairs FROM steps JOIN u USING (id) GROUP BY 1)
SELECT dataset, stem, CAST(len(a) AS INTEGER) AS words, CAST(len(b) AS INTEGER) AS tokens, CAST(coalesce(pairs, 0) AS INTEGER) AS pairs FROM u LEFT JOIN p USING (id)"""
)
def f1_equal_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Words aligned with tokens by equality: pairs found of both lengths."""
    u = assembled(spark, sf)
    pairs = align.equal_pairs_udf(F.transform("words.text", F.lower), F.transform("tokens.text", F.lower))
    return u.where("tokens is not null").select(*UTT, F.size("words").alias("words"), F.size("tokens").alias("tokens"), F.size(pairs).alias("pairs"))


_HANZI = f"""{q.IV}, {q.NESTED}, wr AS (SELECT id, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS ord FROM ul),
word AS (SELECT id, ord, w.t AS text, w.a AS xmin, w.b AS xmax, {q.silence('w.t')} AS sil, {q.punct('w.t')} AS pun FROM wr),
spoken AS (SELECT id, ord, {q.strip('text')} AS text, row_number() OVER (PARTITION BY id ORDER BY ord) AS k FROM word WHERE NOT sil AND NOT pun),
u AS (SELECT id, coalesce((SELECT list(text ORDER BY k) FROM spoken WHERE spoken.id = ul.id), []) AS a, {q.units("replace(text, '<sp1>', '')")} AS b FROM ul),
{q.alignment(q.STANDS_FOR, False)}, met AS (SELECT steps.id, i + 1 AS k, CASE WHEN step = 0 THEN b[j + 1] ELSE a[i + 1] END AS label FROM steps JOIN u USING (id) WHERE step <> 2),
hanzi AS (SELECT dataset, stem, word.ord, xmin, xmax, word.text AS was, sil OR pun AS mute, CASE WHEN sil THEN {q.grade('xmax - xmin')} WHEN pun THEN word.text ELSE coalesce(label, '') END AS text
  FROM word JOIN ul USING (id) LEFT JOIN spoken ON spoken.id = word.id AND spoken.ord = word.ord LEFT JOIN met ON met.id = word.id AND met.k = spoken.k)"""


@query(f"WITH RECURSIVE {_HANZI} SELECT dataset, stem, CAST(ord AS INTEGER) AS ord, xmin, xmax, text FROM hanzi")
def f2_hanzi(spark: SparkSession, sf: str) -> DataFrame:
    """The hanzi tier built from the words by fuzzy alignment with the text."""

    def make(u: dict) -> list[tuple]:
        words = [(w["xmin"], w["xmax"], w["text"]) for w in u["words"]]
        return [(u["dataset"], u["stem"], i, *h) for i, h in enumerate(align.hanzi_labels(words, u["text"] or ""))]

    return steps.per_utterance(assembled(spark, sf).select(*UTT, "words", "text"), make, "dataset string, stem string, ord int, xmin double, xmax double, text string")


@query(f"WITH RECURSIVE {_HANZI} SELECT dataset, stem, CAST(ord AS INTEGER) AS ord, was, text FROM hanzi WHERE NOT mute AND regexp_full_match(text, '[A-Za-z]{{2,}}') AND text <> was")
def f5_spellings(spark: SparkSession, sf: str) -> DataFrame:
    """Words whose spelling the text changes."""

    def make(u: dict) -> list[tuple]:
        words = [(w["xmin"], w["xmax"], w["text"]) for w in u["words"]]
        new = align.spellings_normalised(words, u["text"] or "")
        return [(u["dataset"], u["stem"], i, w[2], n[2]) for i, (w, n) in enumerate(zip(words, new, strict=True)) if w[2] != n[2]]

    return steps.per_utterance(assembled(spark, sf).select(*UTT, "words", "text"), make, "dataset string, stem string, ord int, was string, text string")


@query(
    f"""WITH RECURSIVE {q.IV}, {q.NESTED}, u AS (SELECT id, dataset, stem, tokens AS a, {q.units('text')} AS b FROM ul WHERE tokens IS NOT NULL),
{q.alignment(q.STANDS_FOR, False)}, o AS (SELECT id, i, j, step, row_number() OVER (PARTITION BY id ORDER BY i, j) AS n FROM steps),
m AS (SELECT id, i, step, last_value(CASE WHEN step = 0 THEN j END IGNORE NULLS) OVER (PARTITION BY id ORDER BY n) AS r FROM o),
f AS (SELECT m.id, r, a[i + 1] AS t, b[r + 1] AS w FROM m JOIN u USING (id) WHERE step <> 2 AND r IS NOT NULL),
s AS (SELECT id, r, count(*) AS n, any_value(w) AS w, min(t) AS t, bool_and(NOT {q.vocal('t')} AND (contains(lower(w), lower(t)) OR ({q.pinyin('lower(t)')} AND list_has_any(string_split(lower(t)[:-2], ''), string_split(lower(w), ''))))) AS ok FROM f GROUP BY 1, 2),
c AS (SELECT id, sum(n - 1) AS less FROM s WHERE ok AND regexp_full_match(w, '[A-Za-z]{{2,}}') AND (n > 1 OR w <> t) GROUP BY 1)
SELECT dataset, stem, CAST(len(a) AS INTEGER) AS tokens, CAST(len(a) - less AS INTEGER) AS joined FROM u JOIN c USING (id)"""
)
def f7_english_fragments(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens whose fragments of English words are joined."""

    def make(u: dict) -> list[tuple]:
        tokens = [(t["text"], t["xmin"], t["xmax"]) for t in (u["tokens"] if u["tokens"] is not None else [])]
        new = align.english_fragments(tokens, u["text"] or "")
        return [(u["dataset"], u["stem"], len(tokens), len(new))] if new != tokens else []

    return steps.per_utterance(assembled(spark, sf).select(*UTT, "tokens", "text"), make, "dataset string, stem string, tokens int, joined int")


@query(
    rf"""WITH RECURSIVE {q.IV}, {q.NESTED}, u AS (SELECT id, dataset, stem, list_transform(tokens, lambda t: lower(t)) AS s, regexp_extract_all(text, '[A-Za-z]+') AS w FROM ul WHERE tokens IS NOT NULL),
m(id, n, used, place) AS (SELECT id, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS BIGINT) FROM u UNION ALL
  SELECT id, n + 1, CASE WHEN f > 0 THEN used + f ELSE len(s) END, CASE WHEN f > 0 THEN used + f - 1 END FROM (SELECT m.*, u.s, coalesce(list_position(u.s[used + 1:], lower(u.w[n + 1])), 0) AS f FROM m JOIN u USING (id) WHERE n < len(u.w)) x)
SELECT dataset, stem, CAST(n - 1 AS INTEGER) AS ord, w[n] AS word, CAST(place AS INTEGER) AS place FROM m JOIN u USING (id) WHERE n > 0"""
)
def f8_positional_match(spark: SparkSession, sf: str) -> DataFrame:
    """English words of the text by the tokens that speak them, in order."""

    def make(u: dict) -> list[tuple]:
        wanted = re.findall("[A-Za-z]+", u["text"] or "")
        return [(u["dataset"], u["stem"], i, w, at) for i, (w, at) in enumerate(zip(wanted, align.positional_match([t["text"] for t in u["tokens"]], wanted), strict=True))]

    return steps.per_utterance(assembled(spark, sf).where("tokens is not null").select(*UTT, "tokens", "text"), make, "dataset string, stem string, ord int, word string, place int")


@query(
    rf"""WITH {q.IV}, p AS (SELECT dataset, stem, list(text ORDER BY xmin)[1] AS pinyin FROM iv WHERE tier = 'pinyin' AND xmax > xmin GROUP BY 1, 2), r AS (SELECT dataset, stem, list(text ORDER BY xmin)[1] AS raw FROM iv WHERE tier = 'raw_text' AND xmax > xmin GROUP BY 1, 2),
c AS (SELECT dataset, stem, list_filter(regexp_split_to_array(pinyin, '\s+'), lambda w: {q.word_like('w')}) AS ws, string_split(replace(raw, '<sp1>', ''), '') AS cs FROM p JOIN r USING (dataset, stem) WHERE pinyin IS NOT NULL AND raw IS NOT NULL),
k AS (SELECT dataset, stem, ws, unnest(cs) AS c, generate_subscripts(cs, 1) AS i FROM c), o AS (SELECT *, {q.word_like('c')} AS sound, count(*) FILTER ({q.word_like('c')}) OVER (PARTITION BY dataset, stem ORDER BY i) AS n FROM k)
SELECT dataset, stem, '<sp1> ' || coalesce(string_agg(CASE WHEN sound THEN ws[n] ELSE c END, ' ' ORDER BY i) FILTER (NOT sound OR n <= len(ws)), '') AS pinyin FROM o GROUP BY 1, 2"""
)
def i21_synced_pinyin(spark: SparkSession, sf: str) -> DataFrame:
    """The pinyin of every utterance laid along its text."""
    rows = tiers(spark, sf, "pinyin", "raw_text").where("xmax > xmin")
    both = rows.groupBy(*UTT).agg(*[F.min_by("text", F.when(F.col("tier") == t, F.col("xmin"))).alias(n) for t, n in (("pinyin", "pinyin"), ("raw_text", "raw"))]).where("pinyin is not null and raw is not null and raw <> ''")
    return steps.per_utterance(both, lambda u: [(u["dataset"], u["stem"], align.pinyin_synced(u["pinyin"], u["raw"]))], "dataset string, stem string, pinyin string")


@query()
def g8_fused(spark: SparkSession, sf: str) -> DataFrame:
    """All phases of the fusion, without audio."""
    return fusion.fused(assembled(spark, sf).join(used_lexicon(spark, sf), UTT, "left"))


def _pipeline(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All steps of the mode for complete records, from the tables as delivered, with voiced recordings."""
    raw = table(spark, sf, "nvv_annotations").where("raw_text is not null").groupBy(*UTT).agg(F.min_by("clean_text", "ann_id").alias("text"))
    sound = voices.voiced(audio.nested_words(tiers(spark, sf, "words"))).select(*UTT, "sample_rate", "samples")
    given = {"intervals": _rows(spark, sf), "anchors": ended_rows(spark, sf), "texts": raw, "audio": sound, "records": a10_completeness(spark, sf), "lexicon": table(spark, sf, "lexicon")}
    return pipeline.Pipeline(steps.STEPS, {"resample": {"rate": voices.RATE}}).run(given, "ctc_ready")


@query()
def l9_ctc_ready(spark: SparkSession, sf: str) -> DataFrame:
    """Fused tiers of all complete records, through every step of the pipeline."""
    return _pipeline(spark, sf)["fused"]


@query()
def l9_statuses(spark: SparkSession, sf: str) -> DataFrame:
    """Where each of them is routed."""
    return _pipeline(spark, sf)["statuses"]


@query()
def g8_heard(spark: SparkSession, sf: str) -> DataFrame:
    """All phases of the fusion with the recordings voiced from the words."""
    return fusion.fused(_sounding(spark, sf).join(used_lexicon(spark, sf), UTT, "left"))


@query()
def g2_snapped(spark: SparkSession, sf: str) -> DataFrame:
    """Words snapped to their tokens."""

    def make(u: dict) -> list[tuple]:
        words, phones, tokens, punct = (fusion._items(u[k]) for k in ("words", "phones", "tokens", "punct"))
        new, _ = fusion.snapped(words, phones, tokens, punct)
        return [(u["dataset"], u["stem"], i, w.x0, w.x1, w.text) for i, w in enumerate(new)]

    return steps.per_utterance(assembled(spark, sf), make, "dataset string, stem string, ord int, xmin double, xmax double, text string")


@query()
def g1_punctuated(spark: SparkSession, sf: str) -> DataFrame:
    """Words with the punctuation anchors among them."""

    def make(u: dict) -> list[tuple]:
        words, phones, punct = (fusion._items(u[k]) for k in ("words", "phones", "punct"))
        new, _ = fusion.punctuation_injected(words, phones, punct, max(w.x1 for w in words))
        return [(u["dataset"], u["stem"], i, w.x0, w.x1, w.text, w.kind) for i, w in enumerate(new)]

    return steps.per_utterance(assembled(spark, sf), make, "dataset string, stem string, ord int, xmin double, xmax double, text string, kind string")


@query()
def e3_adjusted_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens and anchors with bounds moved by the energy of the recordings voiced from the words (E1 to E4)."""

    def make(u: dict) -> list[tuple]:
        rows = {k: [{"word": x["text"], "start_s": x["xmin"], "end_s": x["xmax"]} for x in (u[k] if u[k] is not None else [])] for k in ("tokens", "punct")}
        tokens, punct, _ = adjust.adjusted(rows["tokens"], rows["punct"], np.asarray(u["samples"], np.float32), int(u["sample_rate"]))
        return [
            (u["dataset"], u["stem"], kind, i, old["word"], old["start_s"], old["end_s"], new["start_s"], new["end_s"])
            for kind, moved in (("tokens", tokens), ("punct", punct)) for i, (old, new) in enumerate(zip(rows[kind], moved, strict=True))
        ]

    return steps.per_utterance(_sounding(spark, sf), make, "dataset string, stem string, kind string, ord int, word string, old_start double, old_end double, start_s double, end_s double")


@query(
    f"""WITH {q.IV}, w AS (SELECT *, xmin - lag(xmax) OVER (PARTITION BY dataset, stem ORDER BY xmin, xmax, text) AS gap FROM iv WHERE tier = 'words' AND xmax > xmin AND text IS NOT NULL AND NOT {q.silence('text')}),
p AS (SELECT dataset, stem, string_agg(CASE WHEN gap IS NULL THEN '' WHEN gap > 0.05 THEN repeat(' ', 1 + greatest(1, CAST(trunc(gap / 0.03) AS BIGINT))) ELSE ' ' END || text, '' ORDER BY xmin, xmax, text) AS pinyin FROM w GROUP BY 1, 2),
h AS (SELECT dataset, stem, string_agg(text, '' ORDER BY xmin, xmax, text) FILTER (NOT {q.silence('text')}) AS raw FROM iv WHERE tier = 'hanzi' AND xmax > xmin AND text IS NOT NULL GROUP BY 1, 2),
a AS (SELECT DISTINCT dataset, stem FROM iv WHERE tier IN ('words', 'hanzi') AND xmax > xmin AND text IS NOT NULL) SELECT dataset, stem, coalesce(raw, '') AS raw, coalesce(pinyin, '') AS pinyin FROM a LEFT JOIN p USING (dataset, stem) LEFT JOIN h USING (dataset, stem)"""
)
def g7_rebuilt_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Raw text and pinyin of every utterance, built again from its tiers."""
    rows = tiers(spark, sf, "words", "hanzi").where("xmax > xmin and text is not null")
    item = F.struct("xmin", "xmax", "text")
    nested = rows.groupBy(*UTT).agg(*[F.array_sort(F.collect_list(F.when(F.col("tier") == t, item))).alias(t) for t in ("words", "hanzi")])

    def make(u: dict) -> list[tuple]:
        return [(u["dataset"], u["stem"], *fusion.texts_rebuilt(fusion._items(u["words"]), [(h["xmin"], h["xmax"], h["text"]) for h in u["hanzi"]]))]

    return steps.per_utterance(nested, make, "dataset string, stem string, raw string, pinyin string")


def _sounding(spark: SparkSession, sf: str) -> DataFrame:
    sound = voices.voiced(audio.nested_words(tiers(spark, sf, "words"))).select(*UTT, "samples", "sample_rate")
    return assembled(spark, sf).join(sound, UTT, "left")


@query()
def e6_adjust_totals(spark: SparkSession, sf: str) -> DataFrame:
    """How many bounds moved in all, by kind and direction."""
    move = lambda new, old: F.when(F.abs(F.col(new) - F.col(old)) > 1e-9, F.when(F.col(new) > F.col(old), "later").otherwise("earlier")).otherwise("same")
    moved = e3_adjusted_bounds(spark, sf).select("kind", F.explode(F.array(F.struct(F.lit("start").alias("side"), move("start_s", "old_start").alias("moved")), F.struct(F.lit("end").alias("side"), move("end_s", "old_end").alias("moved")))).alias("m"))
    return moved.groupBy("kind", "m.side", "m.moved").agg(F.count(F.lit(1)).alias("n"))


# H: signals as tables of samples; the events' values stand for samples

_DAY = "CAST(floor(epoch_us(ts) / 86400000000) AS BIGINT)"
_FRAMES = f"fr AS (SELECT user_id, {_DAY} AS frame, CAST(sqrt(avg(value * value) + 1e-12) AS FLOAT) AS rms FROM events WHERE value IS NOT NULL GROUP BY 1, 2)"


def _frames(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").where("value is not null")
    day = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 86_400_000_000).cast("bigint")
    return signal.frame_table(events, ["user_id"], day, "value")


@query(f"WITH {_FRAMES} SELECT user_id, frame, rms FROM fr")
def h1_event_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Daily energy of each user's events."""
    return _frames(spark, sf)


@query(
    f"WITH {_FRAMES}, r AS (SELECT user_id, rms, count(*) OVER (PARTITION BY user_id) AS n, row_number() OVER (PARTITION BY user_id ORDER BY rms) - 1 AS i FROM fr) "
    "SELECT user_id, n, rms AS floor FROM r WHERE i = least(greatest(1, CAST(floor(n * 0.15) AS BIGINT)), n - 1)"
)
def h3_event_floor(spark: SparkSession, sf: str) -> DataFrame:
    """Noise floor of each user's daily energy."""
    return signal.floor_table(_frames(spark, sf), ["user_id"], "rms", 0.15)


@query(
    f"WITH {_FRAMES}, f AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY frame) AS i FROM fr), a AS (SELECT *, i - row_number() OVER (PARTITION BY user_id ORDER BY frame) AS g FROM f WHERE rms >= 40), "
    "s AS (SELECT user_id, g, count(*) AS n, min(frame) AS onset FROM a GROUP BY 1, 2) SELECT user_id, min(onset) AS onset FROM s WHERE n >= 3 GROUP BY 1"
)
def h4_event_onset(spark: SparkSession, sf: str) -> DataFrame:
    """First of three loud days in a row."""
    return signal.onset_table(_frames(spark, sf), ["user_id"], "frame", "rms", 40.0, 3)
