"""The steps of the pipeline over tables: what lies between the tables as delivered and the fused tiers.

Tables by name, all but ``intervals`` and ``anchors`` optional:

``intervals``  dataset, stem, tier, interval_id, xmin, xmax, text: the aligner's tiers
``anchors``    dataset, stem, kind (token or punct), interval_id, xmin, xmax, text, with ends
``texts``      dataset, stem, text: the transcript
``audio``      dataset, stem, sample_rate, samples
``records``    dataset, stem, complete: which records are whole; names may differ in letter case
``lexicon``    line_no, token, phones
``fused``      what ``postprocess`` makes: the fused tiers; with it ``statuses``, the routing
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import text as tx
from tessella.functions.lexicon import last_entries
from tessella.functions.tokens import stripped
from tessella.operators import adjust, align, audio, fusion, qc
from tessella.operators import intervals as iv
from tessella.operators import signal as sg
from tessella.session import written

UTT = ["dataset", "stem"]
Tables = dict[str, DataFrame]
_ITEM = "array<struct<xmin:double,xmax:double,text:string>>"


def nested(intervals: DataFrame, anchors: DataFrame) -> DataFrame:
    """One row per utterance with words: its words, phones, tokens and anchors nested in time order, and its text."""
    named = {"words": "words", "pinyin_phones": "phones", "raw_text": "text", "token": "tokens", "punct": "punct"}
    rows = intervals.where("xmax > xmin").select(*UTT, F.col("tier").alias("kind"), "xmin", "xmax", "text")
    rows = rows.unionByName(anchors.select(*UTT, "kind", "xmin", "xmax", "text")).where("text is not null or kind = 'raw_text'")
    item = F.struct("xmin", "xmax", "text")
    lists = rows.groupBy(*UTT).agg(*[F.array_sort(F.collect_list(F.when(F.col("kind") == k, item))).alias(n) for k, n in named.items() if n != "text"], F.min_by("text", F.when(F.col("kind") == "raw_text", F.col("xmin"))).alias("text"))
    some = [F.when(F.size(n) > 0, F.col(n)).alias(n) for n in named.values() if n != "text"]
    return lists.select(*UTT, *some, "text").where("words is not null")


def used_entries(intervals: DataFrame, anchors: DataFrame, lexicon: DataFrame) -> DataFrame:
    """One row per utterance with the lexicon entries of its words, tokens and written English: ``entries``, a map from
    lower-case word to phones.

    The lexicon is joined, not sent: its size has no bound, and only the entries that an utterance can use get there.
    """
    rows = intervals.where("tier in ('words', 'raw_text') and text is not null")
    own = F.when(F.col("tier") == "words", F.array("text")).otherwise(F.regexp_extract_all("text", F.lit("([A-Za-z]+)"), F.lit(1)))
    said = anchors.where("kind = 'token' and text is not null").select(*UTT, F.array("text").alias("w"))
    words = rows.select(*UTT, own.alias("w")).unionByName(said).select(*UTT, F.explode("w").alias("w")).select(*UTT, F.lower(stripped(F.col("w"))).alias("word")).distinct()
    first = last_entries(lexicon).groupBy(F.lower("token").alias("word")).agg(F.min_by("phones", "line_no").alias("phones"))
    return words.join(first, "word").groupBy(*UTT).agg(F.map_from_entries(F.collect_list(F.struct("word", "phones"))).alias("entries"))


def per_utterance(df: DataFrame, make: Callable[[dict], list[tuple]], schema: str) -> DataFrame:
    """The rows that ``make`` gives for each row."""
    names = [c.split()[0] for c in schema.split(", ")]

    def kernel(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([r for u in frame.to_dict("records") for r in make(u)], columns=names)

    return df.mapInPandas(kernel, schema)


def _with_text(tables: Tables) -> DataFrame:
    """``intervals`` in which the raw text is the transcript, where there is one."""
    if "texts" not in tables:
        return tables["intervals"]
    known = tables["texts"].select(*UTT, F.col("text").alias("_said"))
    said = F.when((F.col("tier") == "raw_text") & F.col("_said").isNotNull(), F.col("_said")).otherwise(F.col("text"))
    return tables["intervals"].join(known, UTT, "left").withColumn("text", said).drop("_said")


def link(tables: Tables, settings: dict) -> Tables:
    """Only utterances whose record is complete go on."""
    if "records" not in tables:
        return {}
    whole = tables["records"].where("complete").select(F.lower("dataset").alias("_d"), F.lower("stem").alias("_s")).distinct()
    keep = lambda df: df.join(whole, (F.lower(df["dataset"]) == whole["_d"]) & (F.lower(df["stem"]) == whole["_s"]), "left_semi")
    return {name: keep(tables[name]) for name in ("intervals", "anchors", "texts", "audio") if name in tables}


def trim(tables: Tables, settings: dict) -> Tables:
    """Silences of the recordings capped, and their ends brought to one length."""
    if "audio" not in tables:
        return {}
    s = settings["trim"]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, rates = batch.column("samples"), batch.column("sample_rate").to_pylist()
            made = []
            for x, sr in zip(column.to_pylist(), rates, strict=True):
                x = sg.silence_capped(np.asarray(x or [], np.float32), sr or 16000, s["max_silence_sec"], s["sil_vol_threshold"], s["sil_len_threshold"])
                made.append(sg.edges_normalised(x, sr or 16000, s["target_edge_silence_sec"], s["edge_silence_threshold"], s["edge_frame_length"]))
            yield pa.RecordBatch.from_arrays([batch.column("dataset"), batch.column("stem"), batch.column("sample_rate"), pa.array([m.tolist() for m in made], pa.list_(pa.float32()))], names=["dataset", "stem", "sample_rate", "samples"])

    return {"audio": tables["audio"].select(*UTT, "sample_rate", "samples").mapInArrow(kernel, "dataset string, stem string, sample_rate int, samples array<float>")}


def normalize_punct(tables: Tables, settings: dict) -> Tables:
    """Marks of transcripts and anchors in their ideographic forms."""
    out = {"anchors": tables["anchors"].withColumn("text", F.when(F.col("kind") == "punct", tx.punct_inline(F.col("text"))).otherwise(F.col("text")))}
    if "texts" in tables:
        out["texts"] = tables["texts"].withColumn("text", tx.punct_grouped(F.col("text")))
    return out


def normalize(tables: Tables, settings: dict) -> Tables:
    """Numbers of transcripts as they are read."""
    return {"texts": tables["texts"].withColumn("text", tx.numerals_spelled(F.col("text")))} if "texts" in tables else {}


def normalize_ria(tables: Tables, settings: dict) -> Tables:
    """The name in transcripts, and its fragments among the tokens as one token."""
    tokens = tables["anchors"].where("kind = 'token'")
    pairs = iv.name_pairs(tokens).select("interval_id", F.col("xmax").alias("_to"), "second_id")
    second = pairs.select(F.col("second_id").alias("interval_id"))
    joined = tokens.join(second, "interval_id", "left_anti").join(pairs.drop("second_id"), "interval_id", "left")
    joined = joined.withColumns({"text": F.when(F.col("_to").isNotNull(), tx.NAME).otherwise(F.col("text")), "xmax": F.coalesce("_to", "xmax")}).drop("_to")
    out = {"anchors": joined.unionByName(tables["anchors"].where("kind <> 'token'"))}
    if "texts" in tables:
        out["texts"] = tables["texts"].withColumn("text", tx.name_restored(F.col("text")))
    return out


_ANCHOR = "dataset string, stem string, kind string, interval_id bigint, xmin double, xmax double, text string"


def _items(anchors: DataFrame) -> DataFrame:
    """One row per utterance with ``token`` and ``punct`` nested in time order, ids included."""
    item = F.struct("xmin", "xmax", "interval_id", "text")
    return anchors.where("text is not null").groupBy(*UTT).agg(*[F.array_sort(F.collect_list(F.when(F.col("kind") == k, item))).alias(k) for k in ("token", "punct")])


def normalize_en(tables: Tables, settings: dict) -> Tables:
    """Tokens that are fragments of an English word of the transcript become that word."""
    texts = tables["texts"] if "texts" in tables else tables["intervals"].where("tier = 'raw_text'").groupBy(*UTT).agg(F.min_by("text", "xmin").alias("text"))

    def make(u: dict) -> list[tuple]:
        ids = {(t["text"], t["xmin"]): t["interval_id"] for t in reversed(list(u["token"]))}
        tokens = [(t["text"], t["xmin"], t["xmax"]) for t in u["token"]]
        by_start = {t["xmin"]: t["interval_id"] for t in reversed(list(u["token"]))}
        made = align.english_fragments(tokens, u["text"] or "")
        out = [(u["dataset"], u["stem"], "token", ids.get((t, a), by_start[a]), a, b, t) for t, a, b in made]
        return out + [(u["dataset"], u["stem"], "punct", p["interval_id"], p["xmin"], p["xmax"], p["text"]) for p in u["punct"]]

    return {"anchors": per_utterance(_items(tables["anchors"]).join(texts.select(*UTT, "text"), UTT, "left"), make, _ANCHOR)}


def resample(tables: Tables, settings: dict) -> Tables:
    """Recordings at one rate."""
    if "audio" not in tables:
        return {}
    rows = tables["audio"].withColumn("words", F.array().cast(audio.WORDS))
    return {"audio": audio.resampled(rows, settings["resample"]["rate"]).drop("words")}


def adjust_bounds(tables: Tables, settings: dict) -> Tables:
    """Tokens and anchors moved to where the energy of the recording rises and falls; without recording they stay."""
    if "audio" not in tables:
        return {}

    def make(u: dict) -> list[tuple]:
        rows = {k: [{"word": x["text"], "start_s": x["xmin"], "end_s": x["xmax"], "id": x["interval_id"]} for x in u[k]] for k in ("token", "punct")}
        if u["samples"] is not None and len(u["samples"]):
            rows["token"], rows["punct"], _ = adjust.adjusted(rows["token"], rows["punct"], np.asarray(u["samples"], np.float32), int(u["sample_rate"] or 16000))
        return [(u["dataset"], u["stem"], k, x["id"], x["start_s"], x["end_s"], x["word"]) for k in ("token", "punct") for x in rows[k]]

    moved = per_utterance(_items(tables["anchors"]).join(tables["audio"].select(*UTT, "sample_rate", "samples"), UTT, "left"), make, _ANCHOR)
    return {"anchors": written(moved, "anchors")}


def postprocess(tables: Tables, settings: dict) -> Tables:
    """All tiers fused, and every utterance's status by the quality rules over the fused tiers, which are written once for them."""
    rows = _with_text(tables)
    whole = nested(rows, tables["anchors"])
    if "lexicon" in tables:
        whole = whole.join(used_entries(rows, tables["anchors"], tables["lexicon"]), UTT, "left")
    if "audio" in tables:
        whole = whole.join(tables["audio"].select(*UTT, "sample_rate", "samples"), UTT, "left")
    fused = written(fusion.fused(whole), "fused")
    tiers = fused.where("error is null").select(*UTT, "tier", F.xxhash64(*UTT, "tier", "ord").alias("interval_id"), "ord", "xmin", "xmax", "text")
    heard = audio.recordings(tiers.where("tier = 'words'"), tables["audio"]) if "audio" in tables else None
    return {"fused": fused, "statuses": qc.routed(tiers, qc.reasons(tiers, heard, settings["postprocess"]["filter_word_energy_ratio"]))}


STEPS = {
    "link": link, "trim": trim, "normalize_punct": normalize_punct, "normalize": normalize, "normalize_ria": normalize_ria, "normalize_en": normalize_en, "resample": resample,
    "adjust": adjust_bounds, "postprocess": postprocess,
}
