"""Queries over recordings; the tables hold no audio, so that each utterance is voiced from its words tier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import audio, intervals
from tessella.plans import sqltext as q
from tessella.plans.interval_queries import tiers, token_rows, utterances
from tessella.queries import query
from tessella.sources import textgrid, voices


def heard(spark: SparkSession, sf: str) -> DataFrame:
    return voices.voiced(audio.nested_words(tiers(spark, sf, "words")))


_V = f"WITH {q.IV}, {q.VOICED}"


@query(f"{_V}, {q.frames('fr', 20)} SELECT dataset, stem, CAST(frame AS INTEGER) AS frame, rms FROM fr")
def h1_framed_rms(spark: SparkSession, sf: str) -> DataFrame:
    """Energy of all frames of 20 ms."""
    return audio.frame_energies(heard(spark, sf), 20.0)


@query(f"{_V}, {q.frames('fr', 10)}, {q.floors('fl', 'fr', 0.15)} SELECT dataset, stem, CAST(frames AS INTEGER) AS frames, CAST(floor AS FLOAT) AS floor FROM fl")
def h3_noise_floor(spark: SparkSession, sf: str) -> DataFrame:
    """Noise floor of every recording."""
    return audio.noise_floors(heard(spark, sf))


@query(
    f"""{_V}, {q.frames('fr', 5)}, {q.floors('fl', 'fr', 0.15)}, lim AS (SELECT dataset, stem, CAST(greatest(floor * CAST(3 AS DOUBLE), 1e-3) AS FLOAT) AS t FROM fl),
loud AS (SELECT dataset, stem, frame, frame - row_number() OVER (PARTITION BY dataset, stem ORDER BY frame) AS g FROM fr JOIN lim USING (dataset, stem) WHERE rms >= t),
runs AS (SELECT dataset, stem, min(frame) AS a, max(frame) + 1 AS b FROM loud GROUP BY dataset, stem, g HAVING count(*) >= 3)
SELECT dataset, stem, CAST(min(a) AS INTEGER) AS onset, CAST(max(b) AS INTEGER) AS "offset" FROM len LEFT JOIN runs USING (dataset, stem) GROUP BY 1, 2"""
)
def h4_speech_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """First and last loud frame of every recording (H4, H18)."""
    return audio.speech_bounds(heard(spark, sf))


@query(
    f"""{_V}, {q.ENERGY}, s AS (SELECT interval_id, dataset, stem, (b - a) // 5 AS n, unnest(range(a, b)) AS k, a FROM wv), f AS (SELECT interval_id, n, (k - a) // 5 AS j, sum(v * v) AS e FROM s JOIN cov USING (dataset, stem, k) GROUP BY 1, 2, 3),
l AS (SELECT interval_id, count(*) FILTER (CAST(sqrt(e / 5 + 1e-12) AS FLOAT) > CAST(0.02 AS FLOAT)) / any_value(n) AS loud FROM f WHERE j < n GROUP BY 1)
SELECT dataset, stem, interval_id, energy, energy AS nonzero, coalesce(loud, 0) AS loud FROM we LEFT JOIN l USING (interval_id)"""
)
def h5_word_energy(spark: SparkSession, sf: str) -> DataFrame:
    """Energy of every word, without zeros, and its share of loud frames (H5, H6, H17)."""
    return audio.word_energies(heard(spark, sf), 0.01)


@query(
    f"""{_V}, {q.frames('h', 5)}, win AS (SELECT h.dataset, h.stem, frame, sqrt((e + lead(e) OVER (PARTITION BY dataset, stem ORDER BY frame)) / 10) AS r, n FROM h JOIN len USING (dataset, stem)),
ok AS (SELECT *, max(r) OVER (PARTITION BY dataset, stem) AS top FROM win WHERE frame * 5 < n - 10)
SELECT dataset, stem, round(coalesce(max(frame) FILTER (r > top * 0.05), max(frame)) * 5 / 1000, 3) AS speech_end FROM len LEFT JOIN ok USING (dataset, stem) GROUP BY 1, 2"""
)
def h8_last_speech(spark: SparkSession, sf: str) -> DataFrame:
    """Where speech ends in every recording."""
    return audio.last_speech(heard(spark, sf))


_SILENCES = f"""{q.frames('st', 10)}, loud AS (SELECT dataset, stem, frame, frame - row_number() OVER (PARTITION BY dataset, stem ORDER BY frame) AS g FROM st WHERE top >= 0.003),
sp AS (SELECT loud.dataset, loud.stem, min(frame) AS a, max(frame) + 1 AS b, any_value(n) AS n FROM loud JOIN len USING (dataset, stem) GROUP BY loud.dataset, loud.stem, g HAVING count(*) > CASE WHEN max(frame) + 1 = any_value(n) // 10 THEN 3 ELSE 10 END),
edge AS (SELECT dataset, stem, a, b FROM sp UNION ALL SELECT dataset, stem, n // 10, n // 10 FROM len WHERE n >= 10 AND (dataset, stem) IN (SELECT (dataset, stem) FROM sp)),
gaps AS (SELECT dataset, stem, coalesce(lag(b) OVER (PARTITION BY dataset, stem ORDER BY a, b), 0) AS x, a AS y FROM edge),
sil AS (SELECT dataset, stem, x * 10 AS from_sample, least(y * 10, n) AS to_sample FROM gaps JOIN len USING (dataset, stem) WHERE y - x > 8
  UNION ALL SELECT dataset, stem, 0, n FROM len WHERE n >= 10 AND (dataset, stem) NOT IN (SELECT (dataset, stem) FROM sp))"""


@query(f"{_V}, {_SILENCES} SELECT * FROM sil")
def h9_silence_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Silences between the stretches of speech of every recording."""
    return audio.silences(heard(spark, sf))


@query(
    f"""{_V}, {_SILENCES}, {q.frames('eg', 64)}, l AS (SELECT dataset, stem, min(frame) AS a, max(frame) AS b FROM eg WHERE sqrt(e / 64) >= 0.01 GROUP BY 1, 2),
e AS (SELECT dataset, stem, n, CASE WHEN a IS NULL THEN (n // 64) * 64 / 1000 ELSE a * 64 / 1000 END AS head_s, CASE WHEN a IS NULL THEN (n // 64) * 64 / 1000 ELSE (n // 64 - 1 - b) * 64 / 1000 END AS tail_s FROM len LEFT JOIN l USING (dataset, stem)),
c AS (SELECT dataset, stem, sum(greatest(0, to_sample - from_sample - 1000)) AS cut FROM sil GROUP BY 1, 2),
i AS (SELECT *, CAST(trunc(head_s * 1000) AS BIGINT) AS head, CAST(trunc(tail_s * 1000) AS BIGINT) AS tail FROM e)
SELECT dataset, stem, n AS samples, head_s, tail_s, CAST(n - coalesce(cut, 0) AS BIGINT) AS capped, CASE WHEN tail > 500 THEN greatest(0, n - head + 500 - (tail - 500)) ELSE n - head + 500 + 500 - tail END AS evened FROM i LEFT JOIN c USING (dataset, stem)"""
)
def h10_trimmed_lengths(spark: SparkSession, sf: str) -> DataFrame:
    """Silence at the ends of every recording, and its length with silences capped or ends evened (H10, H11, H12)."""
    return audio.trimmed_lengths(heard(spark, sf), size=64)


@query(f"{_V} SELECT dataset, stem, 1600 AS sample_rate, CAST((n * 8 + 4) // 5 AS INTEGER) AS samples FROM len")
def h14_resampled(spark: SparkSession, sf: str) -> DataFrame:
    """Length of every recording at another rate (H13, H14)."""
    return audio.resampled(heard(spark, sf), 1600).select("dataset", "stem", "sample_rate", F.size("samples").alias("samples"))


@query(
    f"""{_V}, {q.ENERGY}, {q.frames('fr', 10)}, {q.floors('fl', 'fr', 0.6)}, j AS (SELECT we.*, greatest(fl.floor, 1e-6) AS nf FROM we JOIN fl USING (dataset, stem)),
s AS (SELECT dataset, stem, any_value(nf) AS nf, avg(energy) FILTER (NOT sil AND energy > 0) AS voice, sum(xmax - xmin) FILTER (sil AND xmax - xmin >= 0.3) AS total,
  count(*) FILTER (sil AND xmax - xmin >= 0.3 AND energy > greatest(nf * 2, 0.005)) AS loud, sum(xmax - xmin) FILTER (sil AND xmax - xmin >= 0.3 AND energy > greatest(nf * 2, 0.005)) AS suspect FROM j GROUP BY 1, 2)
SELECT dataset, stem, round_even(CAST(nf AS DOUBLE), 6) AS noise_floor, round_even(coalesce(voice, 0), 6) AS avg_speech_energy, CAST(loud AS INTEGER) AS suspect_intervals, round_even(suspect / total, 3) AS suspect_ratio, round_even(total, 3) AS total_sil_dur, round_even(suspect, 3) AS suspect_dur
FROM s WHERE loud > 0 AND suspect / total > 0.1"""
)
def k8_background_suspects(spark: SparkSession, sf: str) -> DataFrame:
    """Recordings whose silences are too loud."""
    return audio.background_suspects(heard(spark, sf))


@query(
    f"""{_V}, {q.ENERGY}, {q.frames('fr', 10)}, {q.floors('fl', 'fr', 0.15)}, f AS (SELECT we.*, CAST(floor AS DOUBLE) AS nf, NOT sil AND ({q.english('text')} OR {q.vocal('text')}) AS other FROM we JOIN fl USING (dataset, stem)),
n AS (SELECT *, other OR coalesce(lag(other) OVER w, FALSE) OR coalesce(lead(other) OVER w, FALSE) AS near FROM f WINDOW w AS (PARTITION BY dataset, stem ORDER BY xmin, xmax, interval_id))
SELECT dataset, stem, text, round_even(energy, 6) AS energy, round_even(nf, 6) AS noise_floor FROM n WHERE NOT near AND NOT sil AND NOT contains('，。…！？、；：', {q.strip('text')}) AND energy > 0 AND energy < nf * 10"""
)
def k9_quiet_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words no louder than silence allows."""
    return audio.quiet_words(heard(spark, sf))


_LABELS = """fs AS (SELECT dataset, stem, n, n // 60 AS frames FROM len), nth AS (SELECT *, row_number() OVER (PARTITION BY dataset, stem ORDER BY xmin, xmax, interval_id) AS k FROM wv),
lab AS (SELECT dataset, stem, frame, max(k) AS label FROM (SELECT dataset, stem, k, unnest(range((a + 59) // 60, (b + 59) // 60)) AS frame FROM nth WHERE NOT sil) JOIN fs USING (dataset, stem) WHERE frame < frames GROUP BY 1, 2, 3),
allf AS (SELECT dataset, stem, frame, coalesce(label, 0) AS label, n FROM (SELECT dataset, stem, n, unnest(range(0, frames)) AS frame FROM fs) LEFT JOIN lab USING (dataset, stem, frame)),
isl AS (SELECT *, frame - row_number() OVER (PARTITION BY dataset, stem, label ORDER BY frame) AS g FROM allf),
run AS (SELECT dataset, stem, label, min(frame) AS a, max(frame) + 1 AS b, any_value(n) AS n FROM isl GROUP BY dataset, stem, label, g)"""


@query(f"{_V}, {_LABELS} SELECT dataset, stem, CAST(a * 60 AS INTEGER) AS start_ms, CAST(b * 60 AS INTEGER) AS end_ms, CAST((b - a) * 60 AS INTEGER) AS duration_ms FROM run WHERE label = 0 AND (b - a) * 60 >= 200")
def h15_pauses(spark: SparkSession, sf: str) -> DataFrame:
    """Blank stretches of the frames' labels."""
    return audio.label_pauses(audio.frame_labels(heard(spark, sf)))


@query(f"{_V}, {_LABELS} SELECT dataset, stem, CAST(label AS INTEGER) AS label, round(greatest((a * 60 - 30) / 1000, 0), 3) AS start_s, round(least((b * 60 - 30) / 1000, n / 1000), 3) AS end_s FROM run WHERE label > 0")
def h16_token_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Stretches of one label, with their times."""
    return audio.label_spans(audio.frame_labels(heard(spark, sf)))


_TWO_TIERS = f"""{q.IV}, {q.VOICED}, {_LABELS}, {q.TOK}, {q.UTT}, f AS (SELECT t.*, u.xmax AS utt_end, lead(t.xmin) OVER (PARTITION BY t.dataset, t.stem ORDER BY t.xmin, t.xmax, t.interval_id) AS nx,
  row_number() OVER (PARTITION BY t.dataset, t.stem ORDER BY t.xmin, t.xmax, t.interval_id) AS r FROM tok t JOIN utt u USING (dataset, stem)),
ps AS (SELECT dataset, stem, a * 60 / 1000 AS xmin, b * 60 / 1000 AS xmax, (b - a) * 60 || 'ms' AS text FROM run WHERE label = 0 AND (b - a) * 60 >= 200),
pf AS (SELECT p.*, u.xmax AS utt_end, lead(p.xmin) OVER w AS nx, row_number() OVER w AS r FROM ps p JOIN utt u USING (dataset, stem) WINDOW w AS (PARTITION BY p.dataset, p.stem ORDER BY p.xmin)),
two AS (SELECT dataset, stem, 'words' AS tier, 0.0 AS xmin, xmin AS xmax, '' AS text FROM f WHERE r = 1 AND xmin > 0.005 UNION ALL SELECT dataset, stem, 'words', xmin, coalesce(nx, xmax), text FROM f
 UNION ALL SELECT dataset, stem, 'words', xmax, utt_end, '' FROM f WHERE nx IS NULL AND utt_end - xmax > 0.005
 UNION ALL SELECT dataset, stem, 'pauses', 0.0, xmin, '' FROM pf WHERE r = 1 AND xmin > 0.005 UNION ALL SELECT dataset, stem, 'pauses', xmin, coalesce(least(xmax, nx), xmax), text FROM pf
 UNION ALL SELECT dataset, stem, 'pauses', coalesce(least(xmax, nx), xmax), coalesce(nx, utt_end), '' FROM pf WHERE coalesce(nx, utt_end) - coalesce(least(xmax, nx), xmax) > 0.005
 UNION ALL SELECT dataset, stem, 'pauses', 0.0, xmax, '' FROM utt WHERE (dataset, stem) NOT IN (SELECT (dataset, stem) FROM ps))"""


def _two_tiers(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.two_tiers(token_rows(spark, sf), h15_pauses(spark, sf), utterances(spark, sf))


@query(f"WITH {_TWO_TIERS} SELECT dataset, stem, CASE tier WHEN 'words' THEN 1 ELSE 2 END AS tier_ord, tier, CAST(row_number() OVER (PARTITION BY dataset, stem, tier ORDER BY xmin, xmax, text) - 1 AS INTEGER) AS ord, xmin, xmax, text FROM two")
def a15_two_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """Words and pauses of every utterance as the two tiers of a grid."""
    return _two_tiers(spark, sf)


@query(f"WITH {_TWO_TIERS} SELECT dataset, stem, tier, count(*) AS n, CAST(sum({q.micros('xmax')} - {q.micros('xmin')}) AS BIGINT) AS micros FROM two GROUP BY 1, 2, 3")
def a15_two_tier_grids(spark: SparkSession, sf: str) -> DataFrame:
    """The same written as TextGrids and read again: intervals and length of each tier."""
    again = textgrid.interval_rows(textgrid.rendered(_two_tiers(spark, sf), ["dataset", "stem"]), ["dataset", "stem"])
    return again.groupBy("dataset", "stem", "tier").agg(F.count(F.lit(1)).alias("n"), F.sum(textgrid.micros(F.col("xmax")) - textgrid.micros(F.col("xmin"))).alias("micros"))


@query(
    f"""{_V}, q AS (SELECT interval_id, wv.dataset, wv.stem, xmin, xmax, a AS s, (least(n, CAST(trunc(least(xmax, xmin + 0.5) * 1000) AS BIGINT)) - a) // 5 AS nf FROM wv JOIN len USING (dataset, stem) WHERE sil AND xmax - xmin >= 0.4),
e AS (SELECT interval_id, (k - s) // 5 AS j, sum(v * v) AS e FROM (SELECT *, unnest(range(s, s + nf * 5)) AS k FROM q WHERE nf > 0) JOIN cov USING (dataset, stem, k) GROUP BY 1, 2),
f AS (SELECT q.*, j, CAST(sqrt(coalesce(e, 0) / 5 + 1e-12) AS FLOAT) AS rms FROM (SELECT *, unnest(range(0, nf)) AS j FROM q WHERE nf > 0) q LEFT JOIN e USING (interval_id, j)),
lim AS (SELECT interval_id, CAST(greatest(CAST(median(rms) FILTER (j >= CAST(trunc(nf * 0.6) AS BIGINT)) AS DOUBLE) * 2.5, CAST(max(rms) AS DOUBLE) * 0.15) AS FLOAT) AS t FROM f GROUP BY 1),
act AS (SELECT f.*, rms > t AS loud, j - row_number() OVER (PARTITION BY interval_id, rms > t ORDER BY j) AS g FROM f JOIN lim USING (interval_id)),
run AS (SELECT interval_id, loud, min(j) AS a, max(j) + 1 AS b FROM act GROUP BY interval_id, loud, g), fst AS (SELECT interval_id, min(a) AS first FROM run WHERE loud AND b - a >= 8 GROUP BY 1),
stop AS (SELECT interval_id, any_value(first) AS first, coalesce(min(greatest(a, first + 8)) FILTER (NOT loud AND b - greatest(a, first + 8) >= 8), max(b) FILTER (loud)) AS last FROM run JOIN fst USING (interval_id) GROUP BY 1),
o AS (SELECT dataset, stem, interval_id, xmin, xmin + first * 0.005::DOUBLE AS from_s, least(xmax, xmin + last * 0.005::DOUBLE + 0.01) AS to_s FROM stop JOIN q USING (interval_id))
SELECT dataset, stem, interval_id, from_s, to_s FROM o WHERE to_s - from_s >= 0.04 AND from_s - xmin <= 0.35"""
)
def h7_bursts(spark: SparkSession, sf: str) -> DataFrame:
    """Speech within long silences of the words tier."""
    return audio.bursts(heard(spark, sf))
