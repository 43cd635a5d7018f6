"""Occurrences and record counts of every distinct term, with marks on rare and common ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A term held by fewer records than this is rare.
RARE_BELOW = 5
#: A term held by more than this share of all records (1 / SHARE) is common.
COMMON_SHARE = 5

_EDGE = r"[\s\p{Z}\[\]<>|]+"


def clean_term(value: Column) -> Column:
    """The value without surrounding blanks, brackets and tag marks, lower case, inner blanks and ``_`` as ``-``.

    Null stays null, and a value of nothing but marks becomes null: neither is a term.
    """
    bare = F.lower(F.regexp_replace(value, f"^{_EDGE}|{_EDGE}$", ""))
    return F.nullif(F.regexp_replace(bare, r"[\s\p{Z}_]+", "-"), F.lit(""))


def record_terms(records: DataFrame, record_id: str, fields: dict[str, Column], version: str | None = None) -> DataFrame:
    """Term counts of each record: (record, field, term, n).

    ``fields`` maps a field's name to an array of raw values. A record delivered more than once counts once, in its
    latest ``version``. Terms are counted per record in the same stage that picks the version, since both are
    clustered on the record. Records without id are left out; null arrays give no terms.
    """
    values = F.struct(*([F.col(version).alias("_v")] if version else []), *[a.alias(f"f{i}") for i, a in enumerate(fields.values())])
    one = records.where(F.col(record_id).isNotNull()).select(F.col(record_id).alias("record"), values.alias("v")).groupBy("record").agg(F.max("v").alias("v"))
    tagged = F.array(*[F.struct(F.lit(name).alias("field"), F.col(f"v.f{i}").alias("raw")) for i, name in enumerate(fields)])
    flat = one.select("record", F.explode(tagged).alias("x")).select("record", "x.field", F.explode("x.raw").alias("raw"))
    return flat.select("record", "field", clean_term(F.col("raw")).alias("term")).where("term is not null").groupBy("record", "field", "term").agg(F.count(F.lit(1)).alias("n"))


def term_frequencies(records: DataFrame, record_id: str, fields: dict[str, Column], version: str | None = None, rare_below: int = RARE_BELOW, common_share: int = COMMON_SHARE) -> DataFrame:
    """(field, term, occurrences, records, mark) for every distinct term of the whole collection.

    Per-record counts are combined by hash on the map side before they are shuffled, so a term that a third of all
    records hold costs one row per map task. ``mark`` is ``rare``, ``common`` or null; rare is tested first. The
    number of all records, those without terms included, is a scalar subquery. An empty table gives no rows.
    """
    sums = record_terms(records, record_id, fields, version).groupBy("field", "term").agg(F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("records"))
    total = records.select(F.count_distinct(record_id).alias("n")).scalar()
    mark = F.when(F.col("records") < rare_below, "rare").when(F.col("records") * common_share > total, "common")
    return sums.withColumn("mark", mark)


def annotation_terms(annotations: DataFrame) -> DataFrame:
    """Frequencies of event types and emotions over annotation records."""
    fields = {"nvv_events": F.col("nvv_events.type"), "emotion": F.array("emotion")}
    return term_frequencies(annotations, "ann_id", fields, "annotated_at")
