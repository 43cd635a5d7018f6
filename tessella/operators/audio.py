"""Energy operators over a table of recordings: one row per utterance with ``sample_rate``, ``samples`` and its ``words``.

``words`` is an array of (interval_id, xmin, xmax, text). All operators are Arrow kernels over list columns: samples stay
one flat buffer per batch, and each utterance is a slice of it. A null or empty recording gives no frames, and energies of 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import tokens as tk
from tessella.operators import qc
from tessella.operators import signal as sg

UTT = ("dataset", "stem")
Words = list[tuple[int, float, float, str]]
KINDS = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "float": pa.float32(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
Make = Callable[[np.ndarray, int, Words], list[tuple]]

WORDS = "array<struct<interval_id:bigint,xmin:double,xmax:double,text:string>>"
RECORDING = f"dataset string, stem string, sample_rate int, samples array<float>, words {WORDS}"


def nested_words(words: DataFrame) -> DataFrame:
    """One row per utterance with its words in time order; rows without bounds or text, or that end before they start, are left out."""
    whole = words.where("xmin is not null and xmax > xmin and text is not null")
    listed = F.array_sort(F.collect_list(F.struct("xmin", "xmax", "interval_id", "text")))
    return whole.groupBy(*UTT).agg(F.transform(listed, lambda w: F.struct(w["interval_id"].alias("interval_id"), w["xmin"].alias("xmin"), w["xmax"].alias("xmax"), w["text"].alias("text"))).alias("words"))


def recordings(words: DataFrame, audio: DataFrame) -> DataFrame:
    """Recordings with the words spoken in them: (dataset, stem, sample_rate, samples, words). Utterances without words have none."""
    return audio.select(*UTT, "sample_rate", "samples").join(nested_words(words), [*UTT], "left")


def _per_recording(table: DataFrame, make: Make, schema: str) -> DataFrame:
    """Rows that ``make`` gives for each recording, behind the utterance's keys."""
    fields = [f.strip().split(" ") for f in schema.split(",")]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            samples, words, rates = batch.column("samples"), batch.column("words"), batch.column("sample_rate").to_pylist()
            flat, at = samples.values.to_numpy(zero_copy_only=False), samples.offsets.to_numpy()
            parts, cut = words.values, words.offsets.to_numpy()
            ids, x0, x1, texts = (parts.field(n).to_pylist() for n in ("interval_id", "xmin", "xmax", "text"))
            of, made = [], []
            for i in range(batch.num_rows):
                mine = list(zip(*(c[cut[i] : cut[i + 1]] for c in (ids, x0, x1, texts)), strict=True))
                rows = make(np.nan_to_num(flat[at[i] : at[i + 1]].astype(np.float32)), int(rates[i] or 16000), mine)
                made += rows
                of += [i] * len(rows)
            head = [batch.column(k).take(pa.array(of, pa.int64())) for k in UTT]
            cols = list(zip(*made, strict=True)) or [[]] * len(fields)
            yield pa.RecordBatch.from_arrays([*head, *[pa.array(list(c), KINDS[k]) for c, (_, k) in zip(cols, fields, strict=True)]], names=[*UTT, *[n for n, _ in fields]])

    empty = F.array().cast(WORDS)
    whole = table.select(*UTT, "sample_rate", F.coalesce("samples", F.array().cast("array<float>")).alias("samples"), F.coalesce("words", empty).alias("words"))
    return whole.mapInArrow(kernel, "dataset string, stem string, " + schema)


def frame_energies(table: DataFrame, frame_ms: float = 5.0) -> DataFrame:
    """(dataset, stem, frame, rms) of frames that do not overlap; what is left at the end is dropped."""
    return _per_recording(table, lambda x, sr, _: list(enumerate(sg.frame_rms(x, sr, frame_ms)[0].tolist())), "frame int, rms float")


def noise_floors(table: DataFrame, frame_ms: float = 10.0, share: float = 0.15) -> DataFrame:
    """(dataset, stem, frames, floor)."""

    def make(x: np.ndarray, sr: int, _: Words) -> list[tuple]:
        rms = sg.frame_rms(x, sr, frame_ms)[0]
        return [(len(rms), sg.noise_floor(rms, share))]

    return _per_recording(table, make, "frames int, floor float")


def speech_bounds(table: DataFrame, frame_ms: float = 5.0, share: float = 0.15, ratio: float = 3.0, least: int = 3) -> DataFrame:
    """(dataset, stem, onset, offset): first frame of the first loud run and end of the last, null without one."""

    def make(x: np.ndarray, sr: int, _: Words) -> list[tuple]:
        rms = sg.frame_rms(x, sr, frame_ms)[0]
        limit = max(sg.noise_floor(rms, share) * ratio, 1e-3)
        return [(sg.speech_onset(rms, 0, limit, least), sg.speech_offset(rms, 0, len(rms), limit, least))]

    return _per_recording(table, make, "onset int, offset int")


def word_energies(table: DataFrame, floor: float, ratio: float = 2.0) -> DataFrame:
    """(dataset, stem, interval_id, energy, nonzero, loud): mean absolute amplitude of each word, the same without zeros,
    and the share of its 5 ms frames louder than ``ratio`` times ``floor``."""

    def make(x: np.ndarray, sr: int, words: Words) -> list[tuple]:
        return [(i, sg.word_energy(x, sr, a, b), sg.nonzero_mean(sg.span(x, sr, a, b)), sg.share_above(x, sr, a, b, floor, ratio)) for i, a, b, _ in words]

    return _per_recording(table, make, "interval_id bigint, energy double, nonzero double, loud double")


def last_speech(table: DataFrame, search_from: float = 0.0) -> DataFrame:
    """(dataset, stem, speech_end): the last frame louder than a twentieth of the loudest; null where there is too little audio."""
    return _per_recording(table, lambda x, sr, _: [(sg.speech_end(x, sr, search_from),)], "speech_end double")


def silences(table: DataFrame, volume: float = 0.003, length: float = 0.08) -> DataFrame:
    """(dataset, stem, from_sample, to_sample) of every silence between stretches of speech."""
    return _per_recording(table, lambda x, sr, _: sg.silence_ranges(x, sr, volume, length), "from_sample bigint, to_sample bigint")


def trimmed_lengths(table: DataFrame, most: float = 1.0, target: float = 0.5, size: int = 1024) -> DataFrame:
    """(dataset, stem, samples, head_s, tail_s, capped, evened): samples of a recording, silence at its ends, samples
    left when silences are capped, and those when both ends are brought to the target."""

    def make(x: np.ndarray, sr: int, _: Words) -> list[tuple]:
        return [(len(x), *sg.edge_silence(x, sr, size=size), len(sg.silence_capped(x, sr, most)), len(sg.edges_normalised(x, sr, target, size=size)))]

    return _per_recording(table, make, "samples bigint, head_s double, tail_s double, capped bigint, evened bigint")


def bursts(table: DataFrame, least_silence: float = 0.4) -> DataFrame:
    """(dataset, stem, interval_id, from_s, to_s): speech found within silent words of ``least_silence`` or more."""

    def make(x: np.ndarray, sr: int, words: Words) -> list[tuple]:
        found = ((i, sg.speech_in_silence(x, sr, a, b)) for i, a, b, t in words if tk.py_silence(t) and b - a >= least_silence)
        return [(i, *f) for i, f in found if f]

    return _per_recording(table, make, "interval_id bigint, from_s double, to_s double")


def resampled(table: DataFrame, target: int = 16000) -> DataFrame:
    """Recordings at the target's rate: (dataset, stem, sample_rate, samples, words). Those at this rate stay as they are."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, rates = batch.column("samples"), batch.column("sample_rate").to_pylist()
            flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            made = [sg.resampled(flat[a:b], r or target, target) if r != target else flat[a:b].astype(np.float32) for a, b, r in zip(at, at[1:], rates, strict=False)]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(m) for m in made])]).astype(np.int32))
            new = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(made) if made else np.zeros(0, np.float32)))
            yield pa.RecordBatch.from_arrays([batch.column("dataset"), batch.column("stem"), pa.array([target] * len(made), pa.int32()), new, batch.column("words")], names=["dataset", "stem", "sample_rate", "samples", "words"])

    whole = table.select(*UTT, "sample_rate", F.coalesce("samples", F.array().cast("array<float>")).alias("samples"), "words")
    return whole.mapInArrow(kernel, RECORDING)


def background_suspects(table: DataFrame, ratio: float = 2.0, speech: float = 1.0) -> DataFrame:
    """(dataset, stem, noise_floor, avg_speech_energy, suspect_intervals, suspect_ratio, total_sil_dur, suspect_dur) of
    utterances whose silences are too loud."""
    names = ("noise_floor", "avg_speech_energy", "suspect_intervals", "suspect_ratio", "total_sil_dur", "suspect_dur")

    def make(x: np.ndarray, sr: int, words: Words) -> list[tuple]:
        found = qc.background_suspect([w[1:] for w in words], x, sr, ratio, speech=speech)
        return [tuple(found[n] for n in names)] if found else []

    return _per_recording(table, make, "noise_floor double, avg_speech_energy double, suspect_intervals int, suspect_ratio double, total_sil_dur double, suspect_dur double")


def quiet_words(table: DataFrame, ratio: float = 10.0) -> DataFrame:
    """(dataset, stem, text, energy, noise_floor) of words no louder than silence allows."""

    def make(x: np.ndarray, sr: int, words: Words) -> list[tuple]:
        return [(f["text"], f["energy"], f["noise_floor"]) for f in qc.words_in_silence([w[1:] for w in words], x, sr, ratio)]

    return _per_recording(table, make, "text string, energy double, noise_floor double")


def frame_labels(table: DataFrame, frame_ms: int = 60) -> DataFrame:
    """(dataset, stem, duration, labels): for each frame the number, from 1, of the word that sounds where it starts, 0 for none; a
    stand-in for a recogniser's labels. Of words that overlap the later one counts."""

    def make(x: np.ndarray, sr: int, words: Words) -> list[tuple]:
        duration = len(x) / sr
        labels = np.zeros(len(x) * 1000 // sr // frame_ms, np.int32)
        at = np.arange(len(labels)) * frame_ms
        for n, (_, a, b, t) in enumerate(words, 1):
            if not tk.py_silence(t):
                labels[(at >= int(a * 1000)) & (at < int(b * 1000))] = n
        return [(duration, labels.tolist())]

    return _per_recording(table, make, "duration double, labels array<int>")


def label_pauses(labels: DataFrame, least_ms: int = 200) -> DataFrame:
    """(dataset, stem, start_ms, end_ms, duration_ms) of blank stretches."""
    return _per_labels(labels, lambda ids, _: sg.pauses(ids, 0, least_ms=least_ms), "start_ms int, end_ms int, duration_ms int")


def label_spans(labels: DataFrame) -> DataFrame:
    """(dataset, stem, label, start_s, end_s) of stretches of one label."""
    return _per_labels(labels, lambda ids, duration: sg.token_spans(ids, 0, duration), "label int, start_s double, end_s double")


def _per_labels(labels: DataFrame, make: Callable[[np.ndarray, float], list[tuple]], schema: str) -> DataFrame:
    fields = [f.strip().split(" ") for f in schema.split(",")]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, durations = batch.column("labels"), batch.column("duration").to_pylist()
            flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            each = [make(flat[a:b], d) for a, b, d in zip(at, at[1:], durations, strict=False)]
            head = [batch.column(k).take(pa.array(np.repeat(np.arange(len(each)), [len(e) for e in each]))) for k in UTT]
            cols = list(zip(*[r for e in each for r in e], strict=True)) or [[]] * len(fields)
            yield pa.RecordBatch.from_arrays([*head, *[pa.array(list(c), KINDS[k]) for c, (_, k) in zip(cols, fields, strict=True)]], names=[*UTT, *[n for n, _ in fields]])

    return labels.mapInArrow(kernel, "dataset string, stem string, " + schema)
