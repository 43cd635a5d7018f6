"""RIFF/WAVE audio: whole files parsed to samples, headers read by themselves, and a writer."""

from __future__ import annotations

import os
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import signal

_PCM, _FLOAT, _EXTENSIBLE = 1, 3, 0xFFFE


def chunks(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("no RIFF/WAVE data")
    at = 12
    while at + 8 <= len(data):
        size = struct.unpack("<I", data[at + 4 : at + 8])[0]
        yield data[at : at + 4], data[at + 8 : at + 8 + size]
        at += 8 + size + size % 2


def decoded(data: bytes, mix: str = "first") -> tuple[np.ndarray, int]:
    """Mono float32 samples between -1 and 1 and their rate; of several channels the first, or with ``mean`` their mean."""
    kind = rate = width = channels = None
    for name, body in chunks(data):
        if name == b"fmt ":
            kind, channels, rate, _, _, width = struct.unpack("<HHIIHH", body[:16])
            if kind == _EXTENSIBLE:
                kind = struct.unpack("<H", body[24:26])[0]
        elif name == b"data":
            if kind is None:
                raise ValueError("data before format")
            n = len(body) // (width // 8)
            if kind == _FLOAT:
                x = np.frombuffer(body, f"<f{width // 8}", n).astype(np.float32)
            elif kind == _PCM and width == 8:
                x = (np.frombuffer(body, np.uint8, n).astype(np.float32) - 128) / 128
            elif kind == _PCM and width == 24:
                b = np.frombuffer(body, np.uint8, n * 3).reshape(n, 3).astype(np.int32)
                x = (((b[:, 0] << 8) | (b[:, 1] << 16) | (b[:, 2] << 24)) >> 8).astype(np.float32) / (1 << 23)
            elif kind == _PCM and width in (16, 32):
                x = np.frombuffer(body, f"<i{width // 8}", n).astype(np.float32) / float(1 << (width - 1))
            else:
                raise ValueError(f"unknown sample format {kind}, {width} bits")
            x = x[: n - n % channels].reshape(-1, channels)
            return (x[:, 0] if mix == "first" else x.mean(axis=1)).astype(np.float32), rate
    raise ValueError("no samples")


def encoded(samples: np.ndarray, rate: int) -> bytes:
    """16-bit mono."""
    body = (np.clip(np.asarray(samples, np.float64), -1, 1) * 32767).round().astype("<i2").tobytes()
    return b"RIFF" + struct.pack("<I", 36 + len(body)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, _PCM, 1, rate, rate * 2, 2, 16) + b"data" + struct.pack("<I", len(body)) + body


def read_folder(spark: SparkSession, path: str, target_rate: int | None = None) -> DataFrame:
    """(stem, sample_rate, samples, error) of all wav files below a folder; small files share read tasks. With
    ``target_rate`` other rates are resampled. A file that can't be read gives its error."""
    from tessella.operators.packing import read_packed

    files = read_packed(spark, path, fmt="binaryFile", recursiveFileLookup="true", pathGlobFilter="*.wav").select(F.regexp_extract("path", r"([^/]+)\.wav$", 1).alias("stem"), "content")

    def kernel(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for stem, content in zip(frame["stem"], frame["content"], strict=True):
                try:
                    x, rate = decoded(bytes(content))
                    if target_rate and rate != target_rate:
                        x, rate = signal.resampled(x, rate, target_rate), target_rate
                    out.append((stem, rate, x, None))
                except (ValueError, struct.error) as e:
                    out.append((stem, None, None, str(e)))
            yield pd.DataFrame(out, columns=["stem", "sample_rate", "samples", "error"])

    return files.mapInPandas(kernel, "stem string, sample_rate int, samples array<float>, error string")


def trimmed(x: np.ndarray, rate: int, most: float = 1.0, volume: float = 0.005, length: float = 0.08, edge: float = 0.5, edge_threshold: float = 0.001) -> np.ndarray:
    """Long silences capped, then both ends brought to the same silence."""
    return signal.edges_normalised(signal.silence_capped(x, rate, most, volume, length), rate, edge, edge_threshold)


def write_folder(audio: DataFrame, path: str, change: Callable[[np.ndarray, int], np.ndarray] = trimmed) -> DataFrame:
    """Each row's samples changed and written as ``path/<stem>.wav``; returns (stem, output, seconds). Files are renamed
    into place; ``path`` must be shared by the executors."""

    def kernel(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(path, exist_ok=True)
        for frame in frames:
            out = []
            for stem, rate, samples in zip(frame["stem"], frame["sample_rate"], frame["samples"], strict=True):
                x = change(np.asarray(samples, np.float32), int(rate))
                place = os.path.join(path, f"{stem}.wav")
                with open(f"{place}.{os.getpid()}", "wb") as f:
                    f.write(encoded(x, int(rate)))
                os.replace(f"{place}.{os.getpid()}", place)
                out.append((stem, place, len(x) / rate))
            yield pd.DataFrame(out, columns=["stem", "output", "seconds"])

    return audio.where("samples is not null").select("stem", "sample_rate", "samples").mapInPandas(kernel, "stem string, output string, seconds double")
