"""The six-file record of an utterance: members read from their contents, indices, completeness, lookup chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.operators.packing import SUFFIXES, plain_content, record_columns

UTT = ["dataset", "stem"]
TOKEN = "word string, start_ms double, end_ms double, start_s double, end_s double, type string"


def members(files: DataFrame) -> DataFrame:
    """One row per file that is a member: (dataset, stem, suffix, layout, file_id, path, modified_at, content).

    ``layout`` is ``nested`` if the file lies in a folder of its stem's name. Contents are read without byte order mark,
    with line feeds, without white space at the end.
    """
    rec = record_columns(F.col("path"))
    low = F.lower(F.replace("path", F.lit("\\"), F.lit("/")))
    nested = low.rlike("/wavs/+(?:\\./+)*[^/]+/+(?:\\./+)*[^/]+$") & ~low.rlike("/wavs/+(?:\\./+)+[^/]+$")
    rows = files.select(*[v.alias(k) for k, v in rec.items()], F.when(nested, "nested").otherwise("flat").alias("layout"), "file_id", "path", "modified_at", plain_content(F.col("content")).alias("content"))
    return rows.where("stem is not null")


def latest(rows: DataFrame, *keys: str) -> DataFrame:
    """The newest version of each member, by time and then id; empty files only where there is nothing else."""
    cols = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*cols), F.struct((F.col("content") != "").cast("int"), "modified_at", "file_id"))
    return rows.groupBy(*keys).agg(best.alias("_m")).select(*keys, *[f"_m.{c}" for c in cols])


def token_lines(rows: DataFrame) -> DataFrame:
    """Tokens of ``_tokens.jsonl`` members: one object a line, blank lines skipped, ``ord`` counted over the others.

    Missing ``*_ms`` and ``type`` are null; a line that is cut off gives a row of nulls with ``broken``.
    """
    lines = F.filter(F.split("content", "\n"), lambda x: F.trim(x) != "")
    each = rows.where("suffix = '_tokens.jsonl'").select(*UTT, "file_id", F.posexplode(lines).alias("ord", "line"))
    parsed = each.select(*UTT, "file_id", "ord", F.from_json("line", TOKEN).alias("j"))
    return parsed.select(*UTT, "file_id", "ord", "j.*", (F.col("j.word").isNull() & F.col("j.start_s").isNull()).alias("broken"))


def punct_entries(rows: DataFrame) -> DataFrame:
    """Anchors of ``_punct.json`` members: an array, none where the file is missing, empty or cut off."""
    kind = f"array<struct<{', '.join(c.replace(' ', ':') for c in TOKEN.split(', ')[:5])}>>"
    parsed = rows.where("suffix = '_punct.json'").select(*UTT, "file_id", F.from_json("content", kind).alias("a"))
    return parsed.select(*UTT, "file_id", F.posexplode("a").alias("ord", "p")).select(*UTT, "file_id", "ord", "p.*")


def lab_tokens(rows: DataFrame) -> DataFrame:
    """Tokens of ``.lab`` members, split at blanks."""
    parts = F.filter(F.split("content", r"\s+"), lambda x: x != "")
    return rows.where("suffix = '.lab'").select(*UTT, "file_id", F.posexplode(parts).alias("ord", "token"))


def first_of_chain(rows: DataFrame, chain: list[str]) -> DataFrame:
    """Text by a chain of suffixes: of each utterance the content of the first that has any, and which one it was."""
    rank = F.array_position(F.array(*map(F.lit, chain)), F.col("suffix"))
    ranked = rows.where(F.col("suffix").isin(*chain) & (F.col("content") != ""))
    return ranked.groupBy(*UTT).agg(F.min_by(F.struct("suffix", "content"), F.struct(rank, "file_id")).alias("m")).select(*UTT, "m.suffix", "m.content")


def file_index(rows: DataFrame) -> DataFrame:
    """(dataset, suffix, stem, file_id): the first file of each stem; nested ones only where a data set has no flat one."""
    flat = rows.groupBy("dataset", "suffix").agg(F.max((F.col("layout") == "flat").cast("int")).alias("any_flat"))
    seen = rows.join(flat, ["dataset", "suffix"]).where((F.col("layout") == "flat") | (F.col("any_flat") == 0))
    return seen.groupBy("dataset", "suffix", "stem").agg(F.min("file_id").alias("file_id"))


def completeness(rows: DataFrame, audio: DataFrame, one_layout: bool = True) -> DataFrame:
    """(dataset, stem, layout, complete) of every stem that has a ``.lab`` and audio.

    The flat layout wins where both have a ``.lab``. With ``one_layout`` all six members must be in that layout,
    otherwise in either.
    """
    by_layout = rows.groupBy(*UTT, "layout").agg(F.collect_set("suffix").alias("have"))
    lab = by_layout.where(F.array_contains("have", ".lab")).groupBy(*UTT).agg(F.min_by(F.struct("layout", "have"), "layout").alias("own"))
    every = by_layout.groupBy(*UTT).agg(F.array_distinct(F.flatten(F.collect_list("have"))).alias("all"))
    both = lab.join(every, UTT).join(audio.select(*UTT).distinct(), UTT, "left_semi")
    have = F.col("own.have") if one_layout else F.col("all")
    return both.select(*UTT, F.col("own.layout").alias("layout"), (F.size(F.array_distinct(have)) == len(SUFFIXES)).alias("complete"))


def wav_candidates(wanted: DataFrame, audio: DataFrame) -> DataFrame:
    """(dataset, stem, rule, audio_stem): audio found for each stem by the first rule that finds any: its own name, its
    digits padded to 5 to 8, or its last number standing free in a name. The least name wins within a rule.

    Each rule is an equi-join on a key computed on both sides.
    """
    number = lambda c: F.regexp_extract(c, r"(\d+)$", 1)
    names = audio.select("dataset", F.col("stem").alias("audio_stem")).distinct()
    own = wanted.select(*UTT).distinct()
    exact = own.join(names, (own["dataset"] == names["dataset"]) & (own["stem"] == names["audio_stem"])).select(own["dataset"], own["stem"], F.lit(1).alias("rule"), "audio_stem")
    digits = own.where(F.col("stem").rlike(r"^\d+$")).select(*UTT, F.explode(F.array(*[F.struct(F.lit(i).alias("w"), F.lpad("stem", w, "0").alias("p")) for i, w in enumerate((5, 6, 7, 8), 2)])).alias("x")).where(F.length("stem") <= F.length("x.p"))
    padded = digits.alias("d").join(names.alias("n"), (F.col("d.dataset") == F.col("n.dataset")) & (F.col("d.x.p") == F.col("n.audio_stem"))).select("d.dataset", "d.stem", F.col("d.x.w").alias("rule"), "n.audio_stem")
    free = names.select("dataset", "audio_stem", F.explode(F.array_distinct(F.regexp_extract_all("audio_stem", F.lit(r"(\d+)"), F.lit(1)))).alias("num")).where(F.col("audio_stem").endswith(F.col("num")))
    tail = own.withColumn("num", number(F.col("stem"))).where("num <> ''").join(free, ["dataset", "num"]).select("dataset", "stem", F.lit(9).alias("rule"), "audio_stem")
    found = exact.unionByName(padded).unionByName(tail)
    return found.groupBy(*UTT).agg(F.min(F.struct("rule", "audio_stem")).alias("m")).select(*UTT, "m.rule", "m.audio_stem")


def audio_names(annotations: DataFrame) -> DataFrame:
    """(dataset, stem) of the audio files that annotations name."""
    return annotations.select("dataset", F.regexp_extract("audio", r"([^/\\]+)\.wav$", 1).alias("stem")).where("stem <> ''").distinct()


def lexicon_lines(lines: DataFrame) -> DataFrame:
    """(line_no, token, phones) of lexicon lines (line_no, value): split at blanks, two fields at least; a byte order mark
    on the first is taken off."""
    parts = F.filter(F.split(F.replace("value", F.lit("﻿"), F.lit("")), r"\s+"), lambda x: x != "")
    return lines.select("line_no", parts.alias("p")).where("size(p) >= 2").select("line_no", F.col("p")[0].alias("token"), F.slice("p", 2, 1_000_000).alias("phones"))


def speaker_counts(rows: DataFrame, audio: DataFrame) -> DataFrame:
    """(dataset, textgrids, wavs, done) by speaker folder; done once there are as many TextGrids as recordings."""
    grids = rows.where("suffix = '.textgrid'").groupBy("dataset").agg(F.count_distinct("stem").alias("textgrids"))
    wavs = audio.groupBy(F.lower("dataset").alias("dataset")).agg(F.count_distinct("stem").alias("wavs"))
    out = wavs.join(grids, "dataset", "left").select("dataset", F.coalesce("textgrids", F.lit(0)).alias("textgrids"), "wavs")
    return out.withColumn("done", F.col("textgrids") >= F.col("wavs"))


def layout_counts(listing: DataFrame, patterns: list[str]) -> DataFrame:
    """(pattern, files): how many files' paths are like each pattern; counted in one pass."""
    counts = listing.agg(*[F.count_if(F.col("path").like(p)).alias(f"c{i}") for i, p in enumerate(patterns)])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(p).alias("pattern"), F.col(f"c{i}").alias("files")) for i, p in enumerate(patterns)])).alias("x")).select("x.*")


def check_layout(listing: DataFrame, patterns: list[str]) -> list[str]:
    """Patterns (SQL ``like`` on ``path``) that no file matches."""
    return [r.pattern for r in layout_counts(listing, patterns).where("files = 0").collect()]


#: Ends of plain reference texts' names that recognisers leave, the bare one first.
REFERENCE_ENDS = ("", "_qwen3-api", "_qwen3", "_firered")


def reference_index(files: DataFrame) -> DataFrame:
    """(dataset, stem, file_id, rank) of plain ``.txt`` texts with content, by the stem they speak of.

    Members of the six-file record are none. ``rank`` is the place of the name's ending in ``REFERENCE_ENDS``: a file named
    without one counts before those of recognisers, and its stem is what is left of the name.
    """
    low = F.regexp_replace(F.lower(F.replace("path", F.lit("\\"), F.lit("/"))), "/{2,}", "/")
    ends = "|".join(e for e in REFERENCE_ENDS if e)
    name = F.regexp_extract(low, r"([^/]+)\.txt$", 1)
    end = F.regexp_extract(name, f"({ends})$", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(low, "([^/]+)/wavs/", 1), F.lit("")), F.regexp_extract(low, "([^/]+)/[^/]+$", 1))
    plain = ~name.rlike("_text_(?:cn|raw)$") & (name != "") & (F.trim(plain_content(F.col("content"))) != "")
    rank = F.array_position(F.array(*map(F.lit, REFERENCE_ENDS)), end) - 1
    found = files.where(plain).select(folder.alias("dataset"), F.substr(name, F.lit(1), F.length(name) - F.length(end)).alias("stem"), "file_id", rank.cast("int").alias("rank"), plain_content(F.col("content")).alias("content"))
    return found.where("dataset <> '' and stem <> ''")


def resolved_texts(members_: DataFrame, references: DataFrame) -> DataFrame:
    """(dataset, stem, source, content): the text of each stem by the whole chain.

    First plain texts in the order of ``REFERENCE_ENDS``, then the record's clean text, raw text and tokens; a stem that bears a
    recogniser's ending itself falls back to what its bare stem has.
    """
    own = first_of_chain(members_, ["_text_cn.txt", "_text_raw.txt", ".lab"])
    ranked = references.select("dataset", "stem", F.col("rank").alias("_r"), F.concat(F.lit(".txt"), F.element_at(F.array(*map(F.lit, REFERENCE_ENDS)), F.col("rank") + 1)).alias("source"), "content", "file_id")
    ranked = ranked.unionByName(own.select("dataset", "stem", F.lit(len(REFERENCE_ENDS)).alias("_r"), F.col("suffix").alias("source"), "content", F.lit(0).cast("bigint").alias("file_id")))
    known = ranked.groupBy("dataset", "stem").agg(F.min_by(F.struct("source", "content"), F.struct("_r", "file_id")).alias("m")).select("dataset", "stem", "m.*")
    stems = members_.select("dataset", "stem").unionByName(references.select("dataset", "stem")).distinct()
    bare = F.regexp_replace("stem", "(?:" + "|".join(e for e in REFERENCE_ENDS if e) + ")$", "")
    lost = stems.join(known, ["dataset", "stem"], "left_anti").where(bare != F.col("stem")).select("dataset", "stem", bare.alias("bare"))
    again = lost.join(known.withColumnRenamed("stem", "bare"), ["dataset", "bare"]).select("dataset", "stem", "source", "content")
    return known.unionByName(again)


def reorganised(rows: DataFrame, path: str) -> None:
    """Members written in one folder per data set. Small data sets share a task, and a large one is split over several."""
    rows.hint("rebalance", "dataset").write.partitionBy("dataset").parquet(path)
