"""Consolidation of very many small files into few well-sized ones.

The scan packs whole small files into combined splits (maximum partition bytes and file-open cost are
tuned to the target), the splits are coalesced without a shuffle, and the rows go to a staging folder
that is verified against what was read before anything is published.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessella.session import discard, shared_dir, with_settings, written

#: Members of an utterance record, as lower-case endings of the file name.
SUFFIXES = (".textgrid", ".lab", "_tokens.jsonl", "_punct.json", "_text_cn.txt", "_text_raw.txt")
#: Characters that count as white space at the end of a file.
SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


class PackingError(RuntimeError):
    """The staged rows differ from the rows read; nothing was published."""


@dataclass(frozen=True)
class Packing:
    """Split packing: ``split_bytes`` is the most a read task takes, a file counts ``open_cost_bytes`` more than
    its size (so a split holds at most their quotient of tiny files), ``file_bytes`` is the size aimed at for
    each file written and ``group_bytes``, before compression, that of the parts in which it can be read."""

    split_bytes: int = 128 << 20
    open_cost_bytes: int = 256 << 10
    file_bytes: int = 64 << 20
    group_bytes: int = 16 << 20

    def session(self, spark: SparkSession) -> SparkSession:
        return with_settings(
            spark,
            {"spark.sql.files.maxPartitionBytes": str(self.split_bytes), "spark.sql.files.openCostInBytes": str(self.open_cost_bytes)},
        )


def input_bytes(df: DataFrame) -> int:
    """Bytes of the scan below ``df`` as the optimizer knows them, without reading rows."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def read_packed(spark: SparkSession, path: str | list[str], packing: Packing = Packing(), fmt: str = "parquet", **options: str) -> DataFrame:
    """A scan whose tasks read combined splits. ``fmt`` may be ``binaryFile`` or ``text`` (with ``wholetext``) for
    folders of tiny files."""
    reader = packing.session(spark).read.format(fmt).options(**options)
    return reader.load(path)


def fingerprint(df: DataFrame, columns: list[str]) -> list[Column]:
    """Order-free sums that change when a row is lost, doubled or altered."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.shiftrightunsigned(row, 32)), F.lit(0)).alias("high"),
        F.coalesce(F.sum(row.bitwiseAND(F.lit(0xFFFFFFFF))), F.lit(0)).alias("low"),
    ]


def stage(df: DataFrame, target: str, packing: Packing = Packing(), size_bytes: int | None = None, also: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Write ``df`` to ``target`` in few files without a shuffle, and verify what was written.

    The fingerprint of the rows read is taken while they are copied, that of the staged rows by reading them back;
    ``PackingError`` is raised if they differ, and the staging is removed. The copying takes one task for each file
    written; what costs more, ``also`` of the staged rows, is written in the pass that verifies, which reads the files in
    as many parts as there are cores. Returns the staged rows and those of ``also``. An empty input gives an empty table
    with the same columns.
    """
    spark = df.sparkSession
    size = input_bytes(df) if size_bytes is None else size_bytes
    files = max(1, math.ceil(size / packing.file_bytes))
    seen, there = Observation(), Observation()
    df.observe(seen, *fingerprint(df, df.columns)).coalesce(files).write.options(compression="zstd", **{"parquet.block.size": str(packing.group_bytes)}).parquet(target)
    staged = spark.read.schema(df.schema).parquet(target)
    read = staged.observe(there, *fingerprint(staged, staged.columns))
    more = None
    if also is None:
        read.write.format("noop").mode("overwrite").save()
    else:
        more = written(also(read), "staged")
    if {k: int(v) for k, v in seen.get.items()} != {k: int(v) for k, v in there.get.items()}:
        discard(spark, target)
        raise PackingError(f"read {seen.get}, staged {there.get}")
    return staged, more


def publish(spark: SparkSession, staged: str, final: str) -> None:
    """Move a verified staging folder to its final place by one rename; refuses to replace anything."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    src, dst = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(final)
    fs = src.getFileSystem(conf)
    if fs.exists(dst):
        raise PackingError(f"{final} exists")
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise PackingError(f"{staged} could not be renamed to {final}")


def record_columns(path: Column) -> dict[str, Column]:
    """Data set, stem and suffix of a member's path, without regard to root, slashes, nesting or letter case.

    All three are null where the path names no member: no ``wavs`` folder below a data set, or another ending.
    """
    clean = F.regexp_replace(F.regexp_replace(F.lower(F.replace(path, F.lit("\\"), F.lit("/"))), "/(?:\\./)+", "/"), "/{2,}", "/")
    endings = "|".join(s.replace(".", "\\.") for s in SUFFIXES)
    shape = f"^(?:.*/)?([^/]+)/wavs/(?:[^/]+/)*([^/]+?)({endings})$"
    found = clean.rlike(shape)
    return {name: F.when(found, F.regexp_extract(clean, shape, i)) for i, name in ((1, "dataset"), (2, "stem"), (3, "suffix"))}


def plain_content(content: Column) -> Column:
    """A file's content without byte order mark, with single line feeds and without white space at the end."""
    bare = F.replace(F.substring(content, 1, 1), F.lit("\ufeff"), F.lit(""))
    body = F.concat(bare, F.substr(content, F.lit(2)))
    return F.rtrim(F.translate(F.replace(body, F.lit("\r\n"), F.lit("\n")), "\r", "\n"), F.lit(SPACE))


def with_records(files: DataFrame) -> DataFrame:
    """Files with their record columns."""
    return files.withColumns({f"rec_{k}": v for k, v in record_columns(F.col("path")).items()})


def digests(files: DataFrame) -> DataFrame:
    """(file_id, same): ``same`` is a digest equal only for files that repeat each other.

    It is null where the path names no record or the content is null: such a file repeats nothing.
    """
    rec = record_columns(F.col("path"))
    parts = F.concat(rec["dataset"], F.lit("/"), rec["stem"], F.lit("/"), rec["suffix"], F.lit("\n"), plain_content(F.col("content")))
    return files.select("file_id", F.unhex(F.sha2(parts.cast("binary"), 256)).alias("same"))


def repeats(members: DataFrame) -> DataFrame:
    """(first_id, repeat_id) for files of one record with equal content; versions of a record are no repeats.

    The first pass keeps one id per content with map-side combining, so a record with very many copies costs
    one row per map task; only contents that occur twice are joined back, and the adaptive join splits hot ones.
    A row delivered twice under one id is one file.
    """
    ids = members.where("same is not null and file_id is not null").select("file_id", "same")
    first = ids.groupBy("same").agg(F.min("file_id").alias("first_id"), F.max("file_id").alias("last_id")).where("first_id < last_id")
    return (
        ids.join(first.select("same", "first_id"), "same")
        .where("file_id > first_id")
        .select("first_id", F.col("file_id").alias("repeat_id"))
        .distinct()
    )


def consolidate(spark: SparkSession, source: str, packing: Packing = Packing(), target: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Stage a table of file contents (file_id, path, content, ...) in few files; returns (staged members, repeats).

    Reads combined splits, coalesces without a shuffle, writes and verifies the staging folder. Null paths and
    contents are staged unchanged. Other columns are carried along; columns named like ours are replaced. The repeats
    don't need the staging any more once it is verified.
    """
    files = read_packed(spark, source, packing)
    files = files.drop(*[c for c in files.columns if c in {"rec_dataset", "rec_stem", "rec_suffix"}])
    staged, same = stage(files, target or shared_dir(spark, "packed"), packing, also=digests)
    return with_records(staged), repeats(same)


def hold_once(staged: DataFrame, repeated: DataFrame, final: str, packing: Packing = Packing()) -> DataFrame:
    """The staged members without repeats, each distinct version once, published at ``final``.

    ``is_latest`` marks the newest version of a record (by ``modified_at``, then ``file_id``). Repeats are taken
    out by an anti join that Spark broadcasts only while their ids are below its threshold; only rows whose id was
    delivered more than once are shuffled. Rows without id are all kept.
    """
    spark = staged.sparkSession
    again = staged.where("file_id is not null").groupBy("file_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("file_id")
    single = staged.join(again, "file_id", "left_anti").unionByName(staged.join(again, "file_id", "left_semi").dropDuplicates(["file_id"]))
    once = single.join(repeated.select(F.col("repeat_id").alias("file_id")), "file_id", "left_anti")
    newest = (
        once.where("rec_stem is not null")
        .groupBy("rec_dataset", "rec_stem", "rec_suffix")
        .agg(F.max(F.struct("modified_at", "file_id")).alias("_top"))
        .select(F.col("_top.file_id").alias("file_id"), F.lit(True).alias("is_latest"))
    )
    out = once.join(newest, "file_id", "left").withColumn("is_latest", F.coalesce("is_latest", F.lit(False)))
    place = shared_dir(spark, "once")
    stage(out, place, packing, input_bytes(staged))
    publish(spark, place, final)
    return spark.read.parquet(final)
