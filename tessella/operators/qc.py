"""Quality rules over finished tiers, and routing by the reasons found.

Each rule is a table (dataset, stem, reason, ...); an utterance may have a reason more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions import lexicon as lx
from tessella.functions import tokens as tk
from tessella.operators import intervals as iv
from tessella.operators import signal as sg

UTT = list(iv.UTT)
PINYIN_IN_TEXT = r"((?<![\p{L}\p{N}_])[a-z]+[1-5](?![\p{L}\p{N}_]))"


def pinyin_in_text(rows: DataFrame) -> DataFrame:
    """Utterances whose raw text holds pinyin syllables, which are listed; marks of silence are none."""
    found = F.regexp_extract_all(F.regexp_replace("text", "<sp[0-9]>", " "), F.lit(PINYIN_IN_TEXT), F.lit(1))
    hits = F.sort_array(F.array_distinct(F.flatten(F.collect_list(found))))
    return rows.where("tier = 'raw_text' and text is not null").groupBy(*UTT).agg(hits.alias("hits")).where("size(hits) > 0")


def incomplete_tiers(rows: DataFrame) -> DataFrame:
    """Utterances that lack one of the written tiers, which are listed in order."""
    there = rows.groupBy(*UTT).agg(F.collect_set("tier").alias("there"))
    missing = F.filter(F.array(*map(F.lit, iv.TIER_ORDER)), lambda t: ~F.array_contains("there", t))
    return there.select(*UTT, missing.alias("missing")).where("size(missing) > 0")


def _sounding(rows: DataFrame, tier: str) -> DataFrame:
    w = iv.by_time()
    sound = rows.where((F.col("tier") == tier) & ~tk.is_silence(F.col("text")))
    return sound.select(*UTT, F.row_number().over(w).alias("i"), tk.stripped(F.col("text")).alias(tier))


def tier_desync(rows: DataFrame, above: float = 0.10) -> DataFrame:
    """Positional comparison of hanzi and words: (dataset, stem, mismatches, total), those above the share only.

    An ideograph wants a pinyin syllable, letters want the same letters; what stands without partner is a mismatch.
    """
    both = _sounding(rows, "hanzi").join(_sounding(rows, "words"), [*UTT, "i"], "full")
    bare = lambda c: F.regexp_replace(F.lower(c), "[012]+$", "")
    letters = F.col("hanzi").rlike("^[A-Za-z]+$")
    wrong = (
        F.when(F.col("hanzi").isNull() | F.col("words").isNull(), True)
        .when(tk.is_cjk(F.col("hanzi")), ~tk.is_pinyin(F.col("words")))
        .when(letters, bare("words") != bare("hanzi"))
        .otherwise(False)
    )
    sums = both.groupBy(*UTT).agg(F.sum(wrong.cast("int")).alias("mismatches"), F.count(F.lit(1)).alias("total"), F.count("hanzi").alias("h"), F.count("words").alias("w"))
    return sums.where(F.col("mismatches") > above * F.col("total")).select(*UTT, "mismatches", "total")


def misaligned_phones(rows: DataFrame, tolerance: float = 0.05, above: float = 0.15) -> DataFrame:
    """Utterances in which too many phones lie in no word: (dataset, stem, outside, total)."""
    phones = rows.where((F.col("tier") == "pinyin_phones") & ~tk.is_silence(F.col("text")))
    words = rows.where((F.col("tier") == "words") & ~tk.is_silence(F.col("text")))
    outside = iv.outside_all(phones, words, tolerance).groupBy(*UTT).agg(F.count(F.lit(1)).alias("outside"))
    total = phones.groupBy(*UTT).agg(F.count(F.lit(1)).alias("total"))
    return total.join(outside, UTT).where(F.col("outside") > above * F.col("total")).select(*UTT, "outside", "total")


def long_silences(rows: DataFrame) -> DataFrame:
    """Silences of the longest grade in the words tier; each is a reason of its own."""
    return rows.where((F.col("tier") == "words") & (tk.stripped(F.col("text")) == "<sp3>")).select(*UTT, "interval_id")


def middle_silences(rows: DataFrame) -> DataFrame:
    """Utterances with a labelled silence that isn't the first interval of the words tier."""
    w = iv.by_time(*UTT, "tier")
    words = rows.where("tier = 'words'").withColumn("i", F.row_number().over(w))
    return words.where((F.col("i") > 1) & tk.is_silence(F.col("text")) & (tk.stripped(F.col("text")) != "")).groupBy(*UTT).agg(F.count(F.lit(1)).alias("n"))


def phone_durations(rows: DataFrame, short: float = 0.015, consonant: float = 999.0, vowel: float = 999.0, short_en: float = 0.010, vowel_en: float = 0.5, consonant_en: float = 1.0) -> DataFrame:
    """Phones too short or too long for their class; phones under vocalisations are not judged."""
    words = rows.where((F.col("tier") == "words") & ~tk.is_silence(F.col("text")))
    phones = rows.where((F.col("tier") == "pinyin_phones") & ~tk.is_silence(F.col("text")))
    judged = iv.outside_all(phones, words.where(tk.is_vocalisation(F.col("text"))), 0.005)
    english = iv.within_any(judged, words.where(tk.is_english(F.col("text"))), 0.005).select("interval_id", F.lit(True).alias("en"))
    d, text = iv.duration(), F.col("text")
    bare = F.regexp_replace(F.replace(text, F.lit(tk.EN_PREFIX), F.lit("")), "[012]+$", "")
    en = F.coalesce("en", F.lit(False))
    rules = F.array(
        F.when(en & (d < short_en), "short_phone_en"), F.when(en & bare.isin(*tk.ENGLISH_VOWELS) & (d > vowel_en), "long_vowel_en"), F.when(en & bare.isin(*tk.ENGLISH_CONSONANTS) & (d > consonant_en), "long_consonant_en"),
        F.when(~en & (d < short), "short_phone"), F.when(~en & tk.is_consonant_phone(text) & (d > consonant), "long_consonant_phone"), F.when(~en & tk.is_vowel_phone(text) & (d > vowel), "long_vowel_phone"),
    )
    out = judged.join(english, "interval_id", "left").withColumn("rule", F.explode(F.filter(rules, lambda r: r.isNotNull())))
    return out.select(*UTT, "interval_id", "rule", "text", F.round(d, 6).alias("duration"))


def low_coverage(rows: DataFrame, least: float = 0.25, from_duration: float = 0.02) -> DataFrame:
    """English words whose prefixed phones cover too little of them."""
    words = rows.where((F.col("tier") == "words") & tk.is_english(F.col("text")) & (iv.duration() >= from_duration))
    phones = rows.where((F.col("tier") == "pinyin_phones") & F.col("text").startswith(tk.EN_PREFIX))
    return iv.covered_share(words, phones).where(F.col("share") < least)


def ideograph_mismatch(rows: DataFrame) -> DataFrame:
    """Utterances whose raw text and hanzi tier hold other ideographs: (dataset, stem, raw_count, hanzi_count, delta)."""
    only = lambda c: F.regexp_replace(c, "[^㐀-䶿一-鿿]", "")
    raw = rows.where("tier = 'raw_text'").groupBy(*UTT).agg(F.min_by("text", F.struct("xmin", "xmax", "interval_id")).alias("raw"))
    listed = F.array_sort(F.collect_list(F.struct("xmin", "xmax", "interval_id", "text")))
    hanzi = rows.where((F.col("tier") == "hanzi") & F.col("text").rlike(r"^\s*[㐀-䶿一-鿿]")).groupBy(*UTT).agg(F.array_join(F.transform(listed, lambda x: tk.stripped(x["text"])), "").alias("hanzi"))
    both = raw.join(hanzi, UTT).select(*UTT, only(F.col("raw")).alias("r"), F.col("hanzi").alias("h")).where("r <> h")
    return both.select(*UTT, F.length("r").alias("raw_count"), F.length("h").alias("hanzi_count"), (F.length("r") - F.length("h")).alias("delta"))


def missing_multiset(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Tokens that occur more often in ``expected`` than in ``actual``: (dataset, stem, token, wanted, found)."""
    a = expected.groupBy(*UTT, "token").agg(F.count(F.lit(1)).alias("wanted"))
    b = actual.groupBy(*UTT, "token").agg(F.count(F.lit(1)).alias("found"))
    return a.join(b, [*UTT, "token"], "left").withColumn("found", F.coalesce("found", F.lit(0))).where("wanted > found")


def reasons(rows: DataFrame, recordings: DataFrame | None = None, quiet_ratio: float = 0.0) -> DataFrame:
    """All filtering reasons, one row each: (dataset, stem, rank, reason). With ``recordings`` also those that need audio: loud
    background, and words in silence where ``quiet_ratio`` is above 0."""
    parts = [
        (pinyin_in_text(rows), "pinyin_in_text"), (incomplete_tiers(rows), "incomplete_tiers"), (tier_desync(rows), "tier_desync"), (misaligned_phones(rows), "misaligned_phones"),
        (long_silences(rows), "sp3"), (middle_silences(rows), "mid_sp"), (iv.unexpected_silences(rows.where("tier = 'words'")), "unexpected_silence"),
    ]
    if recordings is not None:
        from tessella.operators import audio

        parts.append((audio.background_suspects(recordings), "bgm_suspect"))
        if quiet_ratio > 0:
            parts.append((audio.quiet_words(recordings, quiet_ratio).select(*UTT).distinct(), "word_in_silence"))
    out = None
    for rank, (df, reason) in enumerate(parts):
        one = df.select(*UTT, F.lit(rank).alias("rank"), F.lit(reason).alias("reason"))
        out = one if out is None else out.unionByName(one)
    return out


def routed(rows: DataFrame, all_reasons: DataFrame) -> DataFrame:
    """Every utterance with its status: ``ok``, or ``filtered_`` and its reasons with repetitions, and the distinct ones."""
    utterances = rows.select(*UTT).distinct()
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "reason"))), lambda x: x["reason"])
    found = all_reasons.groupBy(*UTT).agg(listed.alias("reasons"))
    out = utterances.join(found, UTT, "left")
    status = F.when(F.col("reasons").isNull(), "ok").otherwise(F.concat(F.lit("filtered_"), F.array_join("reasons", "_")))
    return out.select(*UTT, status.alias("status"), F.array_join(F.array_distinct(F.coalesce("reasons", F.array().cast("array<string>"))), ",").alias("distinct_reasons"))


def filter_rates(statuses: DataFrame, above: float = 0.05) -> DataFrame:
    """Data sets of which more than the share is filtered."""
    sums = statuses.groupBy("dataset").agg(F.count(F.lit(1)).alias("utterances"), F.count_if(F.col("status") != "ok").alias("filtered"))
    return sums.withColumn("rate", F.col("filtered") / F.col("utterances")).where(F.col("rate") > above)


def phone_coverage(rows: DataFrame) -> DataFrame:
    """Phones with their English label and count: mapped, dropped or left as they are."""
    mapped = lx.arpabet(F.col("text"))
    state = F.when(mapped == "", "dropped").when(mapped != tk.stripped(F.col("text")), "mapped").otherwise("kept")
    return rows.groupBy("text").agg(F.count(F.lit(1)).alias("n")).withColumn("state", state)


def neighbours_of(rows: DataFrame, flag: str) -> DataFrame:
    """Rows with ``near``: whether the row beside them bears the flag."""
    w = Window.partitionBy(*UTT).orderBy("xmin", "xmax", "interval_id")
    return rows.withColumn("near", F.coalesce(F.lag(flag).over(w), F.lit(False)) | F.coalesce(F.lead(flag).over(w), F.lit(False)))


# Rules that need audio; kernels over one utterance's rows (xmin, xmax, text).


def background_suspect(words: list[tuple[float, float, str]], audio, rate: int, ratio: float = 2.0, least: float = 0.3, speech: float = 1.0, frame_ms: float = 10.0) -> dict | None:
    """Loud silences: the silences of at least ``least`` seconds whose energy exceeds the floor times ``ratio``, if they make
    up more than a tenth (times ``speech``) of the silence checked. The floor is the frames' order statistic at 60 %."""
    rms, _ = sg.frame_rms(audio, rate, frame_ms)
    floor = max(sg.noise_floor(rms, 0.6), 1e-6)
    limit = max(floor * ratio, 0.005)
    checked = [(a, b, sg.word_energy(audio, rate, a, b)) for a, b, t in words if tk.py_silence(t) and b - a >= least]
    loud = [(a, b, e) for a, b, e in checked if e > limit]
    total, suspect = sum(b - a for a, b, _ in checked), sum(b - a for a, b, _ in loud)
    if not loud or suspect / total <= speech * 0.1:
        return None
    voices = [e for a, b, t in words if not tk.py_silence(t) and (e := sg.word_energy(audio, rate, a, b)) > 0]
    return {
        "rule": "bgm_suspect", "noise_floor": round(floor, 6), "avg_speech_energy": round(sum(voices) / len(voices), 6) if voices else 0.0, "suspect_intervals": len(loud),
        "suspect_ratio": round(suspect / total, 3), "total_sil_dur": round(total, 3), "suspect_dur": round(suspect, 3),
    }


def words_in_silence(words: list[tuple[float, float, str]], audio, rate: int, ratio: float = 0.0) -> list[dict]:
    """Words no louder than the floor allows; off unless ``ratio`` is above 0, and a ratio below 10 counts as 10.

    Punctuation, English words, vocalisations and what stands beside the latter two are not judged.
    """
    if ratio <= 0:
        return []
    rms, _ = sg.frame_rms(audio, rate, 10.0)
    floor = sg.noise_floor(rms, 0.15)
    foreign = [not tk.py_silence(t) and (tk.py_english(t) or tk.py_vocalisation(t)) for _, _, t in words]
    out = []
    for i, (a, b, t) in enumerate(words):
        near = any(foreign[max(0, i - 1) : i + 2])
        if near or tk.py_silence(t) or t.strip() in "，。…！？、；：":
            continue
        energy = sg.word_energy(audio, rate, a, b)
        if 0 < energy < max(floor * ratio, floor * 10):
            out.append({"rule": "word_in_silence", "text": t, "energy": round(energy, 6), "noise_floor": round(floor, 6)})
    return out
