"""The pipeline as data: settings merged over defaults, steps in the order of a mode, each from table to table."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Defaults of the settings.
DEFAULTS: dict = {
    "trim": {"max_silence_sec": 1.0, "sil_vol_threshold": 0.005, "sil_len_threshold": 0.08, "target_edge_silence_sec": 0.5, "edge_silence_threshold": 0.001, "edge_frame_length": 1024},
    "resample": {"rate": 16000},
    "mfa_en": {"padding_ms": 50, "min_segment_dur_ms": 200, "max_gap_merge_s": 0.35},
    "postprocess": {
        "min_sil_merge_sec": 0.2, "merge_energy_threshold": 0.5, "short_word_max_sec": 0.25, "flank_silence_sec": 0.4, "short_word_search_window": 0.5,
        "bgm_noise_floor_ratio": 2.0, "bgm_min_sil_dur": 0.3, "bgm_speech_ratio": 1.0, "filter_word_energy_ratio": 0.0, "filter_short_phone_sec": 0.015,
        "filter_long_consonant_sec": 999, "filter_long_vowel_sec": 999, "filter_short_phone_en_sec": 0.010, "filter_long_vowel_en_sec": 0.5, "filter_long_consonant_en_sec": 1.0,
        "filter_min_en_phone_coverage": 0.25,
    },
    "streaming": {"batch_size": 500, "parallel": 1},
}

# The order of steps in each mode.
ORDERS = {
    "ctc_ready": ("link", "normalize_punct", "normalize", "normalize_ria", "normalize_en", "resample", "adjust", "align", "align_en", "postprocess"),
    "full": ("trim", "resample", "prealign", "normalize_punct", "normalize", "normalize_ria", "normalize_en", "adjust", "align", "align_en", "postprocess"),
}
#: Steps whose work is done by models outside of this library; their tables are inputs.
EXTERNAL = ("prealign", "align", "align_en")


def merged(base: dict, over: dict) -> dict:
    """Settings of ``over`` on top of ``base``, dictionaries by key, anything else as a whole."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def steps_of(mode: str, only: str | None = None, skip_to: str | None = None, skip: Iterable[str] = ()) -> list[str]:
    """The steps to run: one, or those of the mode from one on, without some."""
    order = list(ORDERS[mode])
    if only:
        if only not in order:
            raise ValueError(f"{mode} has no step {only}")
        return [only]
    if skip_to:
        order = order[order.index(skip_to) :]
    left = set(skip)
    return [s for s in order if s not in left]


def selected(datasets: DataFrame, include: Iterable[str] = (), exclude: Iterable[str] = (), limit: int = 0) -> DataFrame:
    """Data sets to process: included, not excluded, then the first by name."""
    out = datasets
    if inc := list(include):
        out = out.where(F.col("name").isin(inc))
    if exc := list(exclude):
        out = out.where(~F.col("name").isin(exc))
    return out.orderBy("name").limit(limit) if limit else out


Step = Callable[[dict[str, DataFrame], dict], dict[str, DataFrame]]


@dataclass
class Pipeline:
    """Steps by name, each from named tables to named tables. A step without function is skipped if it is external and
    its tables are there, and an error otherwise."""

    steps: dict[str, Step]
    settings: dict = field(default_factory=dict)

    def run(self, tables: dict[str, DataFrame], mode: str, **choice) -> dict[str, DataFrame]:
        settings = merged(DEFAULTS, self.settings)
        for name in steps_of(mode, **choice):
            step = self.steps.get(name)
            if step is not None:
                tables = {**tables, **step(tables, settings)}
            elif name not in EXTERNAL:
                raise ValueError(f"no step {name}")
        return tables
