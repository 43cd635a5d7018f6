"""Registered queries of the core and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import coverage as cov
from tessella.operators import packing
from tessella.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_FILES_SQL = r"""
files AS (
  SELECT file_id, content,
    regexp_replace(regexp_replace(lower(replace(path, '\', '/')), '/(\./)+', '/', 'g'), '/{2,}', '/', 'g') AS p
  FROM ctc_file
), members AS (
  SELECT file_id,
    regexp_extract(p, '([^/]+)/wavs/(?:[^/]+/)*([^/]+?)(\.textgrid|\.lab|_tokens\.jsonl|_punct\.json|_text_cn\.txt|_text_raw\.txt)$', 1) AS d,
    regexp_extract(p, '([^/]+)/wavs/(?:[^/]+/)*([^/]+?)(\.textgrid|\.lab|_tokens\.jsonl|_punct\.json|_text_cn\.txt|_text_raw\.txt)$', 2) AS s,
    regexp_extract(p, '([^/]+)/wavs/(?:[^/]+/)*([^/]+?)(\.textgrid|\.lab|_tokens\.jsonl|_punct\.json|_text_cn\.txt|_text_raw\.txt)$', 3) AS x,
    regexp_replace(replace(replace(CASE WHEN starts_with(content, chr(65279)) THEN substr(content, 2) ELSE content END,
      chr(13) || chr(10), chr(10)), chr(13), chr(10)), '\s+$', '') AS c
  FROM files
)
"""


@query(f"""WITH {_FILES_SQL}, firsts AS (
  SELECT d, s, x, c, min(file_id) AS first_id FROM members WHERE d <> '' GROUP BY d, s, x, c HAVING count(DISTINCT file_id) > 1)
SELECT DISTINCT first_id, file_id AS repeat_id FROM members JOIN firsts USING (d, s, x, c) WHERE file_id > first_id""")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that repeat a record, found in the verified staging of all files."""
    place = packing.shared_dir(spark, "packed")
    _, repeated = packing.consolidate(spark, f"{sf_dir}/ctc_file.parquet", target=place)
    packing.discard(spark, place)
    return repeated


@query(f"""WITH {_FILES_SQL}, kept AS (SELECT DISTINCT d, s, x, c FROM members WHERE d <> '')
SELECT d AS dataset, x AS suffix, count(*) AS versions, count(DISTINCT s) AS records FROM kept GROUP BY 1, 2""")
def p1_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents of the consolidated store, every record's versions once, by data set and member."""
    place = packing.shared_dir(spark, "packed")
    staged, repeated = packing.consolidate(spark, f"{sf_dir}/ctc_file.parquet", target=place)
    held = packing.hold_once(staged, repeated, packing.shared_dir(spark, "store"))
    packing.discard(spark, place)
    return (
        held.where("rec_stem is not null")
        .groupBy(F.col("rec_dataset").alias("dataset"), F.col("rec_suffix").alias("suffix"))
        .agg(F.count(F.lit(1)).alias("versions"), F.count_distinct("rec_stem").alias("records"))
    )


@query(f"""WITH {_FILES_SQL}, want AS (
  SELECT DISTINCT lower(name) AS dataset, lower(u.stem) AS stem FROM batch_missing_v3, unnest(stems) AS u(stem) WHERE u.stem IS NOT NULL),
have AS (SELECT d, s, count(DISTINCT x) AS n FROM members WHERE d <> '' AND c <> '' GROUP BY d, s)
SELECT dataset, stem, coalesce(n, 0) AS members FROM want LEFT JOIN have ON d = dataset AND s = stem""")
def p1_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each stem to be filled in, how many of the six members the store has with content."""
    want = table(spark, sf_dir, "batch_missing_v3").select(F.lower("name").alias("dataset"), F.explode("stems").alias("s"))
    want = want.where("s is not null").select("dataset", F.lower("s").alias("stem")).distinct()
    files = packing.read_packed(spark, f"{sf_dir}/ctc_file.parquet")
    rec = packing.record_columns(F.col("path"))
    have = (
        files.select(rec["dataset"].alias("dataset"), rec["stem"].alias("stem"), rec["suffix"].alias("suffix"), (packing.plain_content(F.col("content")) != "").alias("full"))
        .where("stem is not null and full")
        .groupBy("dataset", "stem")
        .agg(F.count_distinct("suffix").alias("n"))
    )
    return want.join(have, ["dataset", "stem"], "left").select("dataset", "stem", F.coalesce("n", F.lit(0)).alias("members"))


_COVER_SQL = """
allrows AS (
  SELECT dataset, stem, lower(tier) AS tier, interval_id AS id, xmin AS a, xmax AS b FROM tier_interval
  UNION ALL SELECT dataset, stem, 'punct', punct_id, start_s, end_s FROM ctc_punct
), r AS (
  SELECT DISTINCT dataset, stem, tier, id, CAST(floor(a * 1000 + 0.5) AS BIGINT) AS a, CAST(floor(b * 1000 + 0.5) AS BIGINT) AS b FROM allrows
  WHERE a IS NOT NULL AND b IS NOT NULL AND isfinite(a) AND isfinite(b)
), rows AS (SELECT * FROM r WHERE a < b),
ev AS (SELECT dataset, stem, tier, t, sum(v) AS v FROM (
  SELECT dataset, stem, tier, a AS t, 1 AS v FROM rows UNION ALL SELECT dataset, stem, tier, b, -1 FROM rows) GROUP BY ALL),
depth AS (SELECT dataset, stem, tier, t, sum(v) OVER w AS n, lead(t) OVER w AS t2 FROM ev
  WINDOW w AS (PARTITION BY dataset, stem, tier ORDER BY t)),
seg AS (SELECT *, n >= 1 AS c1, n >= 2 AS c2 FROM depth WHERE t2 IS NOT NULL)
"""


def _islands(flag: str, kind: str) -> str:
    return f"""SELECT dataset, stem, tier, '{kind}' AS kind, min(t) AS from_ms, max(t2) AS to_ms FROM (
  SELECT *, sum(CASE WHEN {flag} THEN 0 ELSE 1 END) OVER (PARTITION BY dataset, stem, tier ORDER BY t) AS g FROM seg)
WHERE {flag} GROUP BY dataset, stem, tier, g"""


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cov.tier_rows(table(spark, sf_dir, "tier_interval"), table(spark, sf_dir, "ctc_punct"))
    return cov.coverage(rows, ["dataset", "stem", "tier"], "id", "xmin", "xmax")


@query(f"WITH {_COVER_SQL} SELECT * FROM ({_islands('NOT c1', 'gap')}) WHERE tier <> 'punct' UNION ALL {_islands('c2', 'overlap')}")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps and multiply covered stretches of every tier; of the punctuation anchors only the latter."""
    return _coverage(spark, sf_dir).where("kind = 'overlap' or (kind = 'gap' and tier <> 'punct')")


@query(f"WITH {_COVER_SQL} SELECT * FROM ({_islands('c1', 'period')})")
def p3_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous covered periods of every tier and of the punctuation anchors."""
    return _coverage(spark, sf_dir).where("kind = 'period'")
