"""TextGrid files: long format parsed and written by Column expressions, and a data source over folders of them."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessella.functions.text import quoted, seconds_text

_NUMBER = r"([-+0-9.eE]+)"
#: What stands between quotes, doubled quotes included; written so that the engine does not descend a level with each character.
_QUOTED = r'"([^"]*+(?:""[^"]*+)*+)"'
_INTERVAL = rf"intervals \[\d+\]:?\s*xmin = {_NUMBER}\s*xmax = {_NUMBER}\s*text = {_QUOTED}"


def micros(seconds: Column) -> Column:
    """Whole microseconds of a bound, which is what a TextGrid keeps."""
    return F.round(seconds * 1_000_000).cast("bigint")


def parsed(content: Column) -> Column:
    """The tiers of a TextGrid in long format: array of (tier, xmin, xmax, intervals: array of (xmin, xmax, text)).

    Blanks behind values and interval numbers from 0 or 1 are accepted; doubled quotes in texts become single. A text
    without ``item [n]:`` blocks, or with an interval that lacks a bound, gives null: it can't be read.
    """
    items = F.slice(F.split(content, r"item \[\d+\]:"), 2, 1_000_000)
    zipped = lambda item: F.arrays_zip(
        F.transform(F.regexp_extract_all(item, F.lit(_INTERVAL), F.lit(1)), lambda x: x.cast("double")).alias("xmin"),
        F.transform(F.regexp_extract_all(item, F.lit(_INTERVAL), F.lit(2)), lambda x: x.cast("double")).alias("xmax"),
        F.transform(F.regexp_extract_all(item, F.lit(_INTERVAL), F.lit(3)), lambda x: F.replace(x, F.lit('""'), F.lit('"'))).alias("text"),
    )
    kind = "array<struct<xmin:double,xmax:double,text:string>>"
    tiers = F.transform(
        items,
        lambda item: F.struct(
            F.regexp_extract(item, f"name = {_QUOTED}", 1).alias("tier"),
            F.regexp_extract(item, rf"xmin = {_NUMBER}", 1).cast("double").alias("xmin"),
            F.regexp_extract(item, rf"xmax = {_NUMBER}", 1).cast("double").alias("xmax"),
            zipped(item).cast(kind).alias("intervals"),
            F.size(F.regexp_extract_all(item, F.lit(r"(intervals \[\d+\])"), F.lit(1))).alias("_said"),
        ),
    )
    whole = (F.size(tiers) > 0) & F.forall(tiers, lambda t: F.size(t["intervals"]) == t["_said"])
    return F.when(whole, F.transform(tiers, lambda t: F.struct(t["tier"].alias("tier"), t["xmin"].alias("xmin"), t["xmax"].alias("xmax"), t["intervals"].alias("intervals"))))


def interval_rows(files: DataFrame, keys: list[str], content: str = "content") -> DataFrame:
    """One row per interval: (keys, tier_ord, tier, ord, xmin, xmax, text); tiers and intervals count from 0. Files
    that can't be read give none; see ``unreadable``."""
    tiers = files.select(*keys, F.posexplode(parsed(F.col(content))).alias("tier_ord", "t"))
    return tiers.select(*keys, "tier_ord", "t.tier", F.posexplode("t.intervals").alias("ord", "i")).select(*keys, "tier_ord", "tier", "ord", "i.xmin", "i.xmax", "i.text")


def unreadable(files: DataFrame, keys: list[str], content: str = "content") -> DataFrame:
    return files.where(parsed(F.col(content)).isNull()).select(*keys, F.lit("no tiers, or an interval without bounds").alias("error"))


def words_with_phones(rows: DataFrame, keys: list[str], tolerance: float = 0.001) -> DataFrame:
    """Words (first tier that has intervals) with their phones (second) nested and clipped, silences left out:
    (keys, ord, word, xmin, xmax, phones). A phone goes to the first word it touches."""
    from tessella.functions.tokens import is_silence

    place = F.dense_rank().over(_by(keys).orderBy("tier_ord"))
    ranked = rows.withColumn("_t", place)
    words = ranked.where("_t = 1").where(~is_silence(F.col("text"))).select(*keys, F.col("ord").alias("w_ord"), F.col("xmin").alias("w0"), F.col("xmax").alias("w1"), F.col("text").alias("word"))
    phones = ranked.where("_t = 2").where(~is_silence(F.col("text"))).select(*keys, F.col("ord").alias("p_ord"), F.col("xmin").alias("p0"), F.col("xmax").alias("p1"), F.col("text").alias("phone"))
    touch = (F.col("p0") < F.col("w1") - tolerance) & (F.col("p1") > F.col("w0") + tolerance)
    first = words.join(phones, keys).where(touch).groupBy(*keys, "p_ord").agg(F.min_by(F.struct("w_ord", "w0", "w1", "p0", "p1", "phone"), F.struct("w0", "w_ord")).alias("m"))
    nested = first.groupBy(*keys, F.col("m.w_ord").alias("w_ord")).agg(
        F.array_sort(F.collect_list(F.struct("p_ord", F.col("m.phone").alias("phone"), F.greatest("m.p0", "m.w0").alias("start"), F.least("m.p1", "m.w1").alias("end")))).alias("ps")
    )
    plain = F.transform("ps", lambda p: F.struct(p["phone"].alias("phone"), p["start"].alias("start"), p["end"].alias("end")))
    return words.join(nested, [*keys, "w_ord"], "left").select(*keys, F.col("w_ord").alias("ord"), "word", F.col("w0").alias("xmin"), F.col("w1").alias("xmax"), plain.alias("phones"))


def _by(keys: list[str]):
    from pyspark.sql import Window

    return Window.partitionBy(*keys)


def rendered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, content): each utterance's tiers as a TextGrid in long format.

    ``rows`` has tier_ord, tier, ord, xmin, xmax and text; indices are counted from 1 in that order, and a tier spans
    its intervals.
    """
    line = lambda depth, *parts: F.concat(F.lit("    " * depth), *[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit("\n"))
    listed = F.array_sort(F.collect_list(F.struct("ord", "xmin", "xmax", F.coalesce("text", F.lit("")).alias("text"))))
    tiers = rows.groupBy(*keys, "tier_ord", "tier").agg(listed.alias("items"), F.min("xmin").alias("t0"), F.max("xmax").alias("t1"))
    blocks = F.array_join(
        F.transform(
            "items",
            lambda x, i: F.concat(line(2, "intervals [", (i + 1).cast("string"), "]:"), line(3, "xmin = ", seconds_text(x["xmin"])), line(3, "xmax = ", seconds_text(x["xmax"])), line(3, "text = ", quoted(x["text"]))),
        ),
        "",
    )
    body = F.concat(
        line(2, 'class = "IntervalTier"'), line(2, "name = ", quoted(F.col("tier"))), line(2, "xmin = ", seconds_text(F.col("t0"))), line(2, "xmax = ", seconds_text(F.col("t1"))),
        line(2, "intervals: size = ", F.size("items").cast("string")), blocks,
    )
    each = tiers.select(*keys, "tier_ord", "tier", "t0", "t1", body.alias("body"))
    whole = each.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("tier_ord", "tier", "body"))).alias("ts"), F.min("t0").alias("x0"), F.max("t1").alias("x1"))
    items = F.array_join(F.transform("ts", lambda t, i: F.concat(line(1, "item [", (i + 1).cast("string"), "]:"), t["body"])), "")
    head = F.concat(
        line(0, 'File type = "ooTextFile"'), line(0, 'Object class = "TextGrid"'), F.lit("\n"), line(0, "xmin = ", seconds_text(F.col("x0"))), line(0, "xmax = ", seconds_text(F.col("x1"))),
        line(0, "tiers? <exists>"), line(0, "size = ", F.size("ts").cast("string")), line(0, "item []:"),
    )
    return whole.select(*keys, F.concat(head, items).alias("content"))


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """All TextGrids below a folder as interval rows with the stem of their file; small files share read tasks."""
    from tessella.operators.packing import read_packed

    files = read_packed(spark, path, fmt="text", wholetext="true", recursiveFileLookup="true", pathGlobFilter="*.TextGrid")
    stem = F.regexp_extract(F.input_file_name(), r"([^/]+)\.TextGrid$", 1)
    return interval_rows(files.select(F.url_decode(F.replace(stem, F.lit("+"), F.lit("%2B"))).alias("stem"), F.col("value").alias("content")), ["stem"])


def write_folder(rows: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Write each utterance's tiers as ``path/<keys>.TextGrid``; returns (keys, output). ``path`` must be shared by the
    executors. A file is renamed into place, so a task that runs twice leaves one whole file."""
    schema = rendered(rows, keys).select(*keys).schema.add("output", "string")

    def kernel(frames: Iterator) -> Iterator:
        os.makedirs(path, exist_ok=True)
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                place = os.path.join(path, "_".join(str(getattr(row, k)) for k in keys) + ".TextGrid")
                with open(f"{place}.{os.getpid()}", "w", encoding="utf-8") as f:
                    f.write(row.content)
                os.replace(f"{place}.{os.getpid()}", place)
                out.append(place)
            yield frame[keys].assign(output=out)

    return rendered(rows, keys).mapInPandas(kernel, schema)


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class TextGridSource(DataSource):
    """``spark.read.format("textgrid").load(folder)``: interval rows of the TextGrids below a folder that all executors see.

    The folder is listed by the driver, name by name; for millions of files, and for other file systems, use ``read_folder``.
    Options: ``per_partition``, the files read by one task (default 256).
    """

    @classmethod
    def name(cls) -> str:
        return "textgrid"

    def schema(self) -> str:
        return "stem string, tier_ord int, tier string, ord int, xmin double, xmax double, text string"

    def reader(self, schema) -> DataSourceReader:
        return _TextGridReader(self.options)


class _TextGridReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.size = options["path"], int(options.get("per_partition", "256"))

    def partitions(self) -> list[InputPartition]:
        found = sorted(os.path.join(d, f) for d, _, fs in os.walk(self.path) for f in fs if f.endswith(".TextGrid"))
        return [_Files(found[i : i + self.size]) for i in range(0, len(found), self.size)] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[tuple]:
        for path in partition.paths:
            with open(path, encoding="utf-8-sig") as f:
                tiers = parse(f.read())
            stem = os.path.basename(path).removesuffix(".TextGrid")
            for t, (tier, rows) in enumerate(tiers):
                for i, (x0, x1, text) in enumerate(rows):
                    yield stem, t, tier, i, x0, x1, text


def parse(content: str) -> list[tuple[str, list[tuple[float, float, str]]]]:
    """The same reading in plain Python: (tier, [(xmin, xmax, text)]); raises ``ValueError`` where ``parsed`` gives null."""
    import re

    items = re.split(r"item \[\d+\]:", content)[1:]
    if not items:
        raise ValueError("no tiers found")
    out = []
    for item in items:
        name = re.search(r'name = "((?:[^"]|"")*)"', item)
        rows = [(float(a), float(b), t.replace('""', '"')) for a, b, t in re.findall(_INTERVAL, item)]
        if len(rows) != len(re.findall(r"intervals \[\d+\]", item)):
            raise ValueError("an interval lacks a bound")
        out.append((name[1] if name else "", rows))
    return out
