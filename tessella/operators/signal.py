"""Aggregates over sampled audio: framed energy, noise floor, onsets, silence ranges, resampling.

Kernels take a mono float array and its rate; the DataFrame forms at the end work on framed tables without Python.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def framed(audio: np.ndarray, size: int) -> np.ndarray:
    """Whole frames of ``size`` samples; what is left at the end is dropped."""
    n = len(audio) // size
    return np.asarray(audio[: n * size]).reshape(n, size)


def frame_rms(audio: np.ndarray, sr: int, frame_ms: float = 5.0) -> tuple[np.ndarray, float]:
    """Energy of frames that do not overlap, stored as float32, and a frame's seconds (0 if there is none)."""
    size = max(1, int(frame_ms / 1000.0 * sr))
    frames = framed(audio, size).astype(np.float64)
    if not len(frames):
        return np.zeros(0, np.float32), 0.0
    return np.sqrt((frames**2).mean(axis=1) + 1e-12).astype(np.float32), size / sr


def span(audio: np.ndarray, sr: int, start: float, end: float) -> np.ndarray:
    """Samples of the half-open stretch, bounds cut off to whole samples."""
    return audio[max(0, int(start * sr)) : max(0, min(len(audio), int(end * sr)))]


def noise_floor(rms: np.ndarray, share: float = 0.10) -> float:
    """The order statistic at ``max(1, int(n * share))``, counted from 0; 0 for no frames, the only one for one."""
    if not len(rms):
        return 0.0
    k = min(max(1, int(len(rms) * share)), len(rms) - 1)
    return float(np.partition(rms, k)[k])


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of true values as (from, to)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.asarray(flags, np.int8), [0]])))
    return list(zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True))


def speech_onset(rms: np.ndarray, start: int, threshold: float, least: int = 3) -> int | None:
    """First frame of the first run of ``least`` frames at the threshold or above."""
    return next((start + a for a, b in runs(rms[start:] >= threshold) if b - a >= least), None)


def speech_offset(rms: np.ndarray, start: int, end: int, threshold: float, least: int = 3) -> int | None:
    """End of the last such run within the frames."""
    return next((start + b for a, b in reversed(runs(rms[start:end] >= threshold)) if b - a >= least), None)


def word_energy(audio: np.ndarray, sr: int, start: float, end: float) -> float:
    """Mean absolute amplitude; 0 for an empty stretch."""
    part = span(audio, sr, start, end)
    return float(np.abs(part).mean()) if len(part) else 0.0


def nonzero_mean(part: np.ndarray) -> float:
    loud = np.abs(np.asarray(part, np.float32))
    loud = loud[loud > 1e-12]
    return float(loud.mean()) if len(loud) else 0.0


def share_above(audio: np.ndarray, sr: int, start: float, end: float, floor: float, ratio: float) -> float:
    """Share of 5 ms frames louder than ``ratio`` times the floor."""
    rms, _ = frame_rms(span(audio, sr, start, end), sr)
    return float((rms > floor * ratio).mean()) if len(rms) else 0.0


def speech_in_silence(audio: np.ndarray, sr: int, start: float, end: float, search: float = 0.5, frame_ms: float = 10.0, hop_ms: float = 5.0, ratio: float = 2.5, least: float = 0.04) -> tuple[float, float] | None:
    """First burst within a silence: sustained frames above the noise of the last two fifths, up to the next sustained
    pause. None if it is too short or begins later than 0.35 s."""
    rms, step = frame_rms(span(audio, sr, start, min(end, start + search)), sr, hop_ms)
    if not len(rms):
        return None
    tail = rms[int(len(rms) * 0.6) :]
    active = rms > max(float(np.median(tail if len(tail) else rms)) * ratio, float(rms.max()) * 0.15)
    need = max(1, int(least / (hop_ms / 1000.0)))
    first = next((a for a, b in runs(active) if b - a >= need), None)
    if first is None:
        return None
    pause = next((max(a, first + need) for a, b in runs(~active) if b - max(a, first + need) >= need), None)
    last = pause if pause is not None else int(np.flatnonzero(active)[-1]) + 1
    a, b = start + first * step, min(end, start + last * step + frame_ms / 1000.0)
    return None if b - a < least or a - start > 0.35 else (a, b)


def speech_end(audio: np.ndarray, sr: int, search_from: float) -> float | None:
    """Last 10 ms frame (every 5 ms) louder than a twentieth of the loudest, from a time on; None beyond the audio."""
    part = np.asarray(audio[int(search_from * sr) :], np.float64)
    size = int(sr * 0.01)
    hop = size // 2
    if len(part) <= size or not hop:
        return None
    sums = np.concatenate([[0.0], np.cumsum(part**2)])
    at = np.arange(0, len(part) - size, hop)
    rms = np.sqrt((sums[at + size] - sums[at]) / size)
    loud = np.flatnonzero(rms > rms.max() * 0.05)
    return round(search_from + (int(loud[-1]) if len(loud) else len(rms) - 1) * hop / sr, 3)


def edge_silence(audio: np.ndarray, sr: int, threshold: float = 0.01, size: int = 1024) -> tuple[float, float]:
    """Seconds of silent frames at the beginning and at the end; all of them where nothing is louder."""
    frames = framed(audio, size).astype(np.float64)
    if not len(frames):
        return 0.0, 0.0
    loud = np.flatnonzero(np.sqrt((frames**2).mean(axis=1)) >= threshold)
    if not len(loud):
        return (len(frames) * size / sr,) * 2
    return int(loud[0]) * size / sr, (len(frames) - 1 - int(loud[-1])) * size / sr


def edges_normalised(audio: np.ndarray, sr: int, target: float = 0.5, threshold: float = 0.01, size: int = 1024) -> np.ndarray:
    """Silence at both ends cut or filled to the target."""
    head, tail = (int(s * sr) for s in edge_silence(audio, sr, threshold, size))
    want = int(target * sr)
    out = np.asarray(audio, np.float32)
    out = out[head - want :] if head > want else np.concatenate([np.zeros(want - head, np.float32), out])
    return out[: max(0, len(out) - (tail - want))] if tail > want else np.concatenate([out, np.zeros(want - tail, np.float32)])


def silence_ranges(audio: np.ndarray, sr: int, volume: float = 0.003, length: float = 0.08) -> list[tuple[int, int]]:
    """Sample ranges of silence between stretches of speech.

    Speech is a run of more than ten 10 ms steps that reach the volume, at the very end more than three; a silence
    must exceed ``length``. Without speech the whole is one range.
    """
    step = int(sr * 0.01)
    frames = framed(audio, step) if step else np.zeros((0, 1))
    n = len(frames)
    if not n:
        return []
    speech = [(a, b) for a, b in runs(np.abs(frames).max(axis=1) >= volume) if b - a > (3 if b == n else 10)]
    if not speech:
        return [(0, len(audio))]
    need = int(length * sr / step)
    bounds = [0, *[x for ab in speech for x in ab], n]
    gaps = [(a, b) for a, b in zip(bounds[0::2], bounds[1::2], strict=True) if b - a > need]
    return [(a * step, min(b * step, len(audio))) for a, b in gaps]


def silence_capped(audio: np.ndarray, sr: int, most: float = 1.0, volume: float = 0.003, length: float = 0.08) -> np.ndarray:
    """Each silence range keeps its first ``most`` seconds."""
    keep = np.ones(len(audio), bool)
    for a, b in silence_ranges(audio, sr, volume, length):
        keep[a + min(b - a, int(sr * most)) : b] = False
    return audio[keep]


def resampled(audio: np.ndarray, rate: int, target: int, zeros: int = 16) -> np.ndarray:
    """Another rate by a windowed-sinc polyphase filter, exact for constants and for tones well below both limits."""
    audio = np.asarray(audio, np.float64)
    if rate == target or not len(audio):
        return audio.astype(np.float32)
    g = math.gcd(rate, target)
    up, down = target // g, rate // g
    cut = min(1.0, up / down)
    half = int(math.ceil(zeros / cut))
    n = -(-len(audio) * up // down)
    at = np.arange(n) * down / up
    base = np.floor(at).astype(np.int64)
    out, weight = np.zeros(n), np.zeros(n)
    for k in range(-half, half + 1):
        d = at - (base + k)
        w = np.sinc(d * cut) * np.where(np.abs(d) <= half, 0.5 + 0.5 * np.cos(np.pi * d / half), 0.0)
        out += w * audio[np.clip(base + k, 0, len(audio) - 1)]
        weight += w
    return (out / weight).astype(np.float32)


def blank_runs(ids: np.ndarray, blank: int, least: int = 1) -> list[tuple[int, int]]:
    return [(a, b) for a, b in runs(np.asarray(ids) == blank) if b - a >= least]


def pauses(ids: np.ndarray, blank: int, frame_ms: int = 60, least_ms: int = 200) -> list[tuple[int, int, int]]:
    """Blank runs of at least ``least_ms`` as (start_ms, end_ms, duration_ms)."""
    return [(a * frame_ms, b * frame_ms, (b - a) * frame_ms) for a, b in blank_runs(ids, blank) if (b - a) * frame_ms >= least_ms]


def token_spans(ids: np.ndarray, blank: int, duration: float) -> list[tuple[int, float, float]]:
    """Runs of one label apart from the blank as (label, start, end), half a frame earlier, within the audio."""
    ids = np.asarray(ids)
    if not len(ids):
        return []
    cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
    return [(int(ids[a]), round(max((a * 60 - 30) / 1000, 0), 3), round(min((b * 60 - 30) / 1000, duration), 3)) for a, b in zip(cuts, cuts[1:], strict=False) if ids[a] != blank]


# The same on tables of samples: one row per sample or event, no Python.


def frame_table(samples: DataFrame, keys: list[str], frame: Column, value: str) -> DataFrame:
    """(keys, frame, rms): energy of the samples of each frame, as float."""
    v = F.col(value).cast("double")
    return samples.groupBy(*keys, frame.alias("frame")).agg(F.sqrt(F.avg(v * v) + F.lit(1e-12)).cast("float").alias("rms"))


def floor_table(frames: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """(keys, n, floor): order statistic at ``max(1, int(n * share))``; ranked by a window, so a key's values need not
    fit into one array."""
    w = Window.partitionBy(*keys)
    ranked = frames.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("float").alias("v")).withColumn("n", F.count(F.lit(1)).over(w)).withColumn("i", F.row_number().over(w.orderBy("v")) - 1)
    at = F.least(F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(share))), F.col("n") - 1)
    return ranked.where(F.col("i") == at).select(*keys, "n", F.col("v").alias("floor"))


def onset_table(frames: DataFrame, keys: list[str], order: str, value: str, threshold: float, least: int) -> DataFrame:
    """(keys, onset): first row of the first run of ``least`` rows at the threshold or above."""
    w = Window.partitionBy(*keys).orderBy(order)
    flagged = frames.withColumn("_i", F.row_number().over(w)).where(F.col(value) >= threshold)
    island = F.col("_i") - F.row_number().over(w)
    sized = flagged.withColumn("_g", island).groupBy(*keys, "_g").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("onset"))
    return sized.where(F.col("n") >= least).groupBy(*keys).agg(F.min("onset").alias("onset"))
