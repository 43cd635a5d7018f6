"""Recordings made up from tiers, for tests and trial runs where there is no audio.

A sample's size says what is spoken there: within a word ``VOICE`` or ``MURMUR``, within a silence ``HUM`` or ``HUSH``, by
the interval's id, and 0 where no interval lies; its sign alternates. All sizes are powers of two, so that sums and means of samples
are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessella.functions.tokens import py_silence
from tessella.operators.audio import RECORDING

RATE = 1000
VOICE, MURMUR, HUM, HUSH = 2.0**-3, 2.0**-9, 2.0**-5, 2.0**-11


def size_of(interval_id: int, text: str) -> float:
    """Every fourth word is loud, and every fifth silence hums."""
    if py_silence(text):
        return HUSH if interval_id % 5 else HUM
    return MURMUR if interval_id % 4 else VOICE


def voiced(nested: DataFrame, rate: int = RATE) -> DataFrame:
    """Recordings (dataset, stem, sample_rate, samples, words) for utterances with nested ``words``, up to the end of the last."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, made = batch.column("words"), []
            for own in words.to_pylist():
                size = np.zeros(max(0, int(max((w["xmax"] for w in own), default=0.0) * rate)), np.float32)
                for w in own:
                    part = size[max(0, int(w["xmin"] * rate)) : max(0, int(w["xmax"] * rate))]
                    np.maximum(part, np.float32(size_of(w["interval_id"], w["text"])), out=part)
                size[1::2] *= -1
                made.append(size)
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(m) for m in made])]).astype(np.int32))
            samples = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(made) if made else np.zeros(0, np.float32)))
            yield pa.RecordBatch.from_arrays([batch.column("dataset"), batch.column("stem"), pa.array([rate] * len(made), pa.int32()), samples, words], names=["dataset", "stem", "sample_rate", "samples", "words"])

    return nested.select("dataset", "stem", "words").mapInArrow(kernel, RECORDING)
