"""SQL fragments shared by the queries' SQL."""

from __future__ import annotations

from tessella.functions import tokens as tk


def names(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def silence(c: str) -> str:
    return f"({strip(c)} IN ({names(tk.SILENCE)}) OR starts_with({strip(c)}, '<sp') OR {strip(c)} = '')"


def vocal(c: str) -> str:
    return f"(upper(regexp_replace({strip(c)}, '^[<>]+|[<>]+$', '', 'g')) IN ({names(tk.VOCALISATIONS)}))"


def pinyin(c: str) -> str:
    return f"regexp_matches({c}, '^[a-z]+[1-5]$')"


def english(c: str) -> str:
    return f"(regexp_matches({c}, '^[A-Za-z]+$') AND NOT {vocal(c)})"


def word_like(c: str) -> str:
    return rf"(regexp_matches({c}, '^\p{{L}}|^\p{{Nd}}+$') OR {vocal(c)})"


def punct(c: str) -> str:
    return f"({strip(c)} <> '' AND NOT {word_like(c)})"


def grade(d: str) -> str:
    return f"(CASE WHEN {d} < 0.2 THEN '<sp0>' WHEN {d} < 0.5 THEN '<sp1>' WHEN {d} < 1.5 THEN '<sp2>' ELSE '<sp3>' END)"


def micros(c: str) -> str:
    """Whole microseconds, rounded as decimals are."""
    return f"CAST(round(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38, 20)), 6) * 1000000 AS BIGINT)"


#: Tier rows with both bounds, each id once.
IV = "iv AS (SELECT DISTINCT interval_id, dataset, stem, lower(tier) AS tier, ord, xmin, xmax, text FROM tier_interval WHERE xmin IS NOT NULL AND xmax IS NOT NULL)"
_ENDED = """(SELECT *, min(xmin) OVER (PARTITION BY dataset, stem ORDER BY us RANGE BETWEEN 1001 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM (
  SELECT *, CAST(round(xmin * 1000000) AS BIGINT) AS us FROM (
    SELECT DISTINCT 'token' AS kind, token_id AS interval_id, dataset, stem, start_s AS xmin, end_s AS own, word AS text FROM ctc_token WHERE start_s IS NOT NULL
    UNION ALL SELECT DISTINCT 'punct', punct_id, dataset, stem, start_s, end_s, word FROM ctc_punct WHERE start_s IS NOT NULL)))"""
#: Tokens and punctuation anchors as intervals, each id once; those without end last until the next start of their utterance, the
#: last token until its own start and the last anchor 60 ms.
TOK = f"tok AS (SELECT interval_id, dataset, stem, xmin, coalesce(own, later, xmin) AS xmax, text FROM {_ENDED} WHERE kind = 'token')"
PUN = f"pun AS (SELECT interval_id, dataset, stem, xmin, coalesce(own, later, xmin + 0.06) AS xmax, text FROM {_ENDED} WHERE kind = 'punct')"
UTT = "utt AS (SELECT dataset, stem, max(xmax) AS xmax FROM utterance GROUP BY 1, 2)"
W = "PARTITION BY dataset, stem ORDER BY xmin, xmax, interval_id"
WT = "PARTITION BY dataset, stem, tier ORDER BY xmin, xmax, interval_id"
#: Recordings made up from the words tier: ``wv`` the words with their samples, ``len`` samples of each utterance, ``cov`` the size of
#: each sample that isn't 0.
VOICED = f"""wv AS (SELECT interval_id, dataset, stem, xmin, xmax, text, {silence('text')} AS sil, greatest(0, CAST(trunc(xmin * 1000) AS BIGINT)) AS a, greatest(0, CAST(trunc(xmax * 1000) AS BIGINT)) AS b,
  CASE WHEN {silence('text')} THEN CASE WHEN interval_id % 5 = 0 THEN 0.03125 ELSE 0.00048828125 END WHEN interval_id % 4 = 0 THEN 0.125 ELSE 0.001953125 END AS amp
  FROM iv WHERE tier = 'words' AND xmax > xmin AND text IS NOT NULL),
len AS (SELECT dataset, stem, max(b) AS n FROM wv GROUP BY 1, 2),
cov AS (SELECT dataset, stem, k, max(CAST(amp AS DOUBLE)) AS v FROM (SELECT dataset, stem, amp, unnest(range(a, b)) AS k FROM wv) GROUP BY 1, 2, 3)"""


def frames(name: str, size: int) -> str:
    """Frames of so many samples: energy ``rms`` and greatest ``top``; also those in which all samples are 0."""
    return f"""{name}_e AS (SELECT dataset, stem, k // {size} AS frame, sum(v * v) AS e, max(v) AS top FROM cov GROUP BY 1, 2, 3),
{name}_n AS (SELECT dataset, stem, unnest(range(0, n // {size})) AS frame FROM len),
{name} AS (SELECT dataset, stem, frame, CAST(sqrt(coalesce(e, 0) / {size} + 1e-12) AS FLOAT) AS rms, coalesce(e, 0) AS e, coalesce(top, 0) AS top FROM {name}_n LEFT JOIN {name}_e USING (dataset, stem, frame))"""


def floors(name: str, frame: str, share: float) -> str:
    """Noise floor of each utterance's frames."""
    return f"""{name}_r AS (SELECT dataset, stem, rms, count(*) OVER w AS n, row_number() OVER (PARTITION BY dataset, stem ORDER BY rms) - 1 AS i FROM {frame} WINDOW w AS (PARTITION BY dataset, stem)),
{name}_f AS (SELECT dataset, stem, n, rms FROM {name}_r WHERE i = least(greatest(1, CAST(floor(n * {share}) AS BIGINT)), n - 1)),
{name} AS (SELECT dataset, stem, coalesce(f.n, 0) AS frames, coalesce(f.rms, 0) AS floor FROM len LEFT JOIN {name}_f f USING (dataset, stem))"""


#: Energy of each word.
ENERGY = """en AS (SELECT interval_id, CAST(coalesce(sum(v) / any_value(m), 0) AS FLOAT) AS energy FROM (SELECT interval_id, dataset, stem, b - a AS m, unnest(range(a, b)) AS k FROM wv) JOIN cov USING (dataset, stem, k) GROUP BY 1),
we AS (SELECT wv.*, CAST(coalesce(energy, 0) AS DOUBLE) AS energy FROM wv LEFT JOIN en USING (interval_id))"""


def alignment(match: str, exact: bool) -> str:
    """Global alignment at unit costs of ``u`` (id, a, b), lists of texts: ``steps`` (id, i, j, step) from the end back.

    ``match`` is a condition on ``x`` and ``y``. Each row of the cost table is a list; steps are 0 for a pair, 1 for an item of
    ``a`` alone, 2 for one of ``b``; on ties a pair goes first if ``exact``, else an item of ``a``, then one of ``b``.
    """
    differ = lambda x, y: "CASE WHEN " + match.replace("{x}", x).replace("{y}", y) + " THEN 0 ELSE 1 END"
    pair = f"i > 0 AND j > 0 AND c1[j + 1] = c0[j] + {differ('a[i]', 'b[j]')}"
    a, b = "i > 0 AND c1[j + 1] = c0[j + 1] + 1", "j > 0 AND c1[j + 1] = c1[j] + 1"
    first = f"WHEN {pair} THEN 0 WHEN {a} THEN 1 ELSE 2" if exact else f"WHEN {a} THEN 1 WHEN {b} THEN 2 ELSE 0"
    return f"""costs(id, i, c) AS (SELECT id, CAST(0 AS BIGINT), range(0, len(b) + 1) FROM u UNION ALL
  SELECT id, i + 1, list_reduce(list_prepend([i + 1], list_transform(range(1, len(b) + 1), lambda j: [least(c[j + 1] + 1, c[j] + {differ('a[i + 1]', 'b[j]')})])), lambda acc, x: list_append(acc, least(x[1], acc[-1] + 1)))
  FROM costs JOIN u USING (id) WHERE i < len(a)),
trace(id, i, j, step) AS (SELECT id, CAST(len(a) AS BIGINT), CAST(len(b) AS BIGINT), CAST(NULL AS INTEGER) FROM u UNION ALL
  SELECT id, CASE WHEN s = 2 THEN i ELSE i - 1 END, CASE WHEN s = 1 THEN j ELSE j - 1 END, s FROM (
    SELECT t.id, t.i, t.j, CASE {first} END AS s FROM (SELECT t.id, t.i, t.j, u.a, u.b, d1.c AS c1, d0.c AS c0 FROM trace t JOIN u ON u.id = t.id JOIN costs d1 ON d1.id = t.id AND d1.i = t.i LEFT JOIN costs d0 ON d0.id = t.id AND d0.i = t.i - 1 WHERE t.i > 0 OR t.j > 0) t)),
steps AS (SELECT * FROM trace WHERE step IS NOT NULL)"""


#: Whether token ``x`` can stand for the written unit ``y``, without a table of readings.
STANDS_FOR = r"""(CASE WHEN regexp_matches({y}, '^[一-鿿]') THEN regexp_full_match(lower(trim({x})), '[a-z]+[1-5]') WHEN NOT regexp_full_match({y}, '[\x00-\x7F]*') THEN FALSE
  ELSE contains(lower({y}), lower(trim({x}))) OR contains(lower(trim({x})), lower({y})) OR contains(trim(lower({y}), '<>'), trim(lower(trim({x})), '<>')) OR contains(trim(lower(trim({x})), '<>'), trim(lower({y}), '<>'))
    OR regexp_full_match(trim({x}), '\p{L}+\p{Nd}') END)"""


#: Ideographs one by one, letters with digits and hyphens together, other characters by themselves.
UNIT_SHAPE = r"[一-鿿]|[\p{Latin}\p{Greek}\p{Cyrillic}\p{Armenian}\p{Cherokee}\p{Coptic}\p{Hiragana}\p{Katakana}\p{Hangul}\p{N}\-\x{3400}-\x{4DBF}]+|[^\s]"


def units(c: str) -> str:
    """The units of a text that are words."""
    return f"list_filter(regexp_extract_all({c}, '{UNIT_SHAPE}'), lambda w: {word_like('w')})"


#: Words, tokens and text of each utterance as the kernels take them.
NESTED = f"""wl AS (SELECT dataset, stem, list({{'t': text, 'a': xmin, 'b': xmax}} ORDER BY xmin, xmax, text) AS words FROM iv WHERE tier = 'words' AND xmax > xmin AND text IS NOT NULL GROUP BY 1, 2),
tl AS (SELECT dataset, stem, list(word ORDER BY start_s, end_s, word) AS tokens FROM (SELECT DISTINCT token_id, dataset, stem, start_s, end_s, word FROM ctc_token WHERE start_s IS NOT NULL AND word IS NOT NULL) GROUP BY 1, 2),
xl AS (SELECT dataset, stem, list(text ORDER BY xmin)[1] AS text FROM iv WHERE tier = 'raw_text' AND xmax > xmin GROUP BY 1, 2),
ul AS (SELECT row_number() OVER (ORDER BY dataset, stem) AS id, dataset, stem, words, tokens, coalesce(text, '') AS text FROM wl LEFT JOIN tl USING (dataset, stem) LEFT JOIN xl USING (dataset, stem))"""
