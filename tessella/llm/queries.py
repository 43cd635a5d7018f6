"""Registered queries of the text and training-data operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import containers, leakage, lookalike, quality, runs, terms
from tessella.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_SQL: dict[str, str | Callable[[], str]] = {}


def query(sql: str | Callable[[], str] | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def oracle() -> dict[str, str]:
    """The queries' SQL; what needs the tables of characters is made here, not on import."""
    return {name: sql if isinstance(sql, str) else sql() for name, sql in _SQL.items()}


_TERMS_SQL = r"""WITH one AS (SELECT DISTINCT ON (ann_id) ann_id, nvv_events, emotion FROM nvv_annotations WHERE ann_id IS NOT NULL ORDER BY ann_id, annotated_at DESC),
raw AS (SELECT ann_id, 'nvv_events' AS field, u.e.type AS v FROM one, unnest(nvv_events) AS u(e) UNION ALL SELECT ann_id, 'emotion', emotion FROM one),
t AS (SELECT ann_id, field, regexp_replace(lower(regexp_replace(v, '^[\s\[\]<>|]+|[\s\[\]<>|]+$', '', 'g')), '[\s_]+', '-', 'g') AS term FROM raw),
f AS (SELECT field, term, CAST(count(*) AS BIGINT) AS occurrences, count(DISTINCT ann_id) AS records FROM t WHERE term <> '' GROUP BY 1, 2),
m AS (SELECT *, CASE WHEN records < 5 THEN 'rare' WHEN records * 5 > (SELECT count(*) FROM one) THEN 'common' END AS mark FROM f) """


@query(_TERMS_SQL + "SELECT field, term, mark FROM m WHERE mark IS NOT NULL")
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of events and emotions too rare or too common to be useful."""
    return terms.annotation_terms(table(spark, sf_dir, "nvv_annotations")).where("mark is not null").select("field", "term", "mark")


@query(_TERMS_SQL + "SELECT field, term, occurrences, records, mark FROM m")
def p2_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences and record counts of every distinct term."""
    return terms.annotation_terms(table(spark, sf_dir, "nvv_annotations"))


@lru_cache(1)
def _forms_sql() -> str:
    """Forms of texts: characters that stand for one or none are translated, the engine's own canonical composition does the
    rest. Accented letters of other scripts without a composed Latin form, which the tables lack, are left out."""
    single, gone = [], []
    for c, parts in lookalike.fold_rows():
        form = unicodedata.normalize("NFC", "".join(p for p, _ in parts))
        if c != "\0" and len(form) < 2 and form != unicodedata.normalize("NFC", c):
            (single if form else gone).append((c, form))
    quoted = lambda x: x.replace("'", "''")
    turned = quoted("".join(c for c, _ in [*single, *gone])), quoted("".join(f for _, f in single))
    return f"""texts AS (SELECT raw_text AS text FROM nvv_annotations UNION SELECT text FROM tier_interval UNION SELECT token FROM lexicon),
forms AS (SELECT text, nfc_normalize(translate(text, '{turned[0]}', '{turned[1]}')) AS form FROM texts WHERE text IS NOT NULL)"""


def _p4_found_sql() -> str:
    return f"""WITH {_forms_sql()}, a AS (SELECT DISTINCT dataset, stem, ann_id, raw_text, form FROM nvv_annotations JOIN forms ON raw_text = text),
lex AS (SELECT token, min(line_no) AS line, any_value(form) AS form FROM lexicon JOIN forms ON token = text GROUP BY token)
SELECT DISTINCT 'annotation' AS src, a.ann_id AS key_a, b.ann_id AS key_b FROM a JOIN a b USING (dataset, stem, form) WHERE a.ann_id < b.ann_id AND a.raw_text <> b.raw_text
UNION ALL SELECT DISTINCT 'interval', lex.line, interval_id FROM tier_interval t JOIN forms f ON t.text = f.text JOIN lex ON lex.form = f.form
WHERE lower(tier) = 'words' AND interval_id IS NOT NULL AND t.text NOT IN (SELECT token FROM lex)"""


def _p4_forms_sql() -> str:
    return f"WITH {_forms_sql()}, used AS (SELECT raw_text AS text FROM nvv_annotations UNION SELECT text FROM tier_interval) SELECT text, form FROM forms JOIN used USING (text)"


@query(_p4_found_sql)
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations and words written with other characters than the text they look like."""
    return lookalike.lookalikes(*(table(spark, sf_dir, t) for t in ("nvv_annotations", "tier_interval", "lexicon")))


@query(_p4_forms_sql)
def p4_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consistent form of every distinct text of annotations and tiers."""
    texts = table(spark, sf_dir, "nvv_annotations").select(F.col("raw_text").alias("text")).unionByName(table(spark, sf_dir, "tier_interval").select("text"))
    return lookalike.text_forms(texts).select("text", "form")


_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F))) + "\u3000"
_NARROW = "".join(map(chr, range(0x21, 0x7F))).replace("'", "''") + " "
_RUNS_SQL = rf"""WITH one AS (SELECT DISTINCT ON (dataset, stem, token_id) dataset, stem, token_id, word, start_s, coalesce(end_s, start_s) AS end_s FROM ctc_token
  WHERE token_id IS NOT NULL AND start_s IS NOT NULL ORDER BY dataset, stem, token_id, start_s, end_s, word),
bare AS (SELECT *, string_split(regexp_replace(lower(translate(word, '{_WIDE}', '{_NARROW}')), '[\[\]<>|\s\p{{Z}}_\-]+', '', 'g'), '') AS c FROM one),
keyed AS (SELECT *, nullif(array_to_string(list_filter(c, lambda x, i: i = 1 OR x <> c[i - 1] OR NOT regexp_matches(x, '^\p{{L}}$')), ''), '') AS key FROM bare),
cut AS (SELECT *, sum(CASE WHEN key = before THEN 0 ELSE 1 END) OVER (PARTITION BY dataset, stem ORDER BY start_s, token_id) AS g
  FROM (SELECT *, lag(key) OVER (PARTITION BY dataset, stem ORDER BY start_s, token_id) AS before FROM keyed)),
r AS (SELECT dataset, stem, arg_min(token_id, (start_s, token_id)) AS first_id, arg_max(token_id, (start_s, token_id)) AS last_id, any_value(key) AS key, count(*) AS n,
  min(start_s) AS start_s, max(end_s) AS end_s, max(end_s) - min(start_s) AS duration_s FROM cut GROUP BY dataset, stem, g HAVING count(*) > 1) """


@query(_RUNS_SQL + "SELECT first_id AS first_token_id, last_id AS last_token_id FROM r")
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last token of every maximal run of alike tokens."""
    found = runs.event_runs(table(spark, sf_dir, "ctc_token"))
    return found.select(F.col("first_id").alias("first_token_id"), F.col("last_id").alias("last_token_id"))


@query(_RUNS_SQL + "SELECT * FROM r")
def p5_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run of alike tokens as one token with its count and duration."""
    return runs.event_runs(table(spark, sf_dir, "ctc_token")).select("dataset", "stem", "first_id", "last_id", "key", "n", "start_s", "end_s", "duration_s")


@query()
def p5_alike(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of tokens alike by three quarters of their letters, each within two seconds of the run before it, as one token."""
    found = runs.event_runs(table(spark, sf_dir, "ctc_token"), min_similarity=0.75, max_gap_s=2.0)
    return found.select("dataset", "stem", "first_id", "last_id", "key", "n", "start_s", "end_s", "duration_s")


@query()
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold half or more of a test item's wording."""
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item")).select("doc_id", "item_id")


@query()
def p7_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test item with the number of documents that give it away and the largest share of its wording."""
    items = table(spark, sf_dir, "eval_item")
    found = leakage.leaks(table(spark, sf_dir, "documents"), items).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max("share").alias("share"))
    return items.select("item_id", "suite", "lang").join(found, "item_id", "left").fillna(0)


@query()
def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are not natural prose."""
    kinds = quality.document_kinds(table(spark, sf_dir, "documents"), table(spark, sf_dir, "doc_label"))
    return quality.not_prose(kinds).select("doc_id")


@query()
def p8_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and kind of every document."""
    return quality.document_kinds(table(spark, sf_dir, "documents"), table(spark, sf_dir, "doc_label"))


@query()
def p6_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's container of 2,048 tokens."""
    return containers.fill_containers(table(spark, sf_dir, "documents"), 2048)


@query()
def p6_room(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers and room left unused for capacities from 512 to 8,192 tokens."""
    lengths = containers.written(containers.token_lengths(table(spark, sf_dir, "documents")), "lengths")
    rooms = [containers.room_left(containers.packed(lengths, c)) for c in (512, 1024, 2048, 4096, 8192)]
    return reduce(DataFrame.unionByName, rooms)
