import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from tessella.operators import adjust, align, fusion, signal
from tessella.operators.fusion import Item

SR = 16000


def tone(seconds, level=0.3, hz=400.0):
    return (level * np.sin(2 * np.pi * hz * np.arange(int(round(seconds * SR))) / SR)).astype(np.float32)


def audio_of(*parts):
    """(seconds, level) -> samples; level 0 is faint noise."""
    rng = np.random.default_rng(1)
    return np.concatenate([tone(s, v) if v else rng.normal(0, 1e-4, int(round(s * SR))).astype(np.float32) for s, v in parts])


# signal


def test_frame_rms_closed_form():
    rms, step = signal.frame_rms(tone(1.0, 0.5), SR, 5.0)
    assert rms.dtype == np.float32 and len(rms) == 200 and step == 0.005
    assert np.allclose(rms, 0.5 / math.sqrt(2), atol=2e-3)
    assert signal.frame_rms(np.zeros(10), SR)[1] == 0.0


@pytest.mark.parametrize("n", [1, 2, 6, 7, 100])
def test_noise_floor_index(n):
    x = np.random.default_rng(n).random(n).astype(np.float32)
    assert signal.noise_floor(x, 0.15) == float(np.sort(x)[min(max(1, int(n * 0.15)), n - 1)])


def test_onset_offset_and_runs():
    x = np.array([0, 1, 1, 0, 1, 1, 1, 0, 1, 1, 1, 1], float)
    assert signal.runs(x > 0) == [(1, 3), (4, 7), (8, 12)]
    assert signal.speech_onset(x, 0, 1, 3) == 4 and signal.speech_onset(x, 5, 1, 3) == 8 and signal.speech_onset(x, 0, 1, 5) is None
    assert signal.speech_offset(x, 0, 8, 1, 3) == 7


def test_energies():
    x = np.array([0.0, 0.5, -0.5, 0.0], np.float32)
    assert signal.word_energy(x, 4, 0.0, 1.0) == 0.25 and signal.nonzero_mean(x) == 0.5 and signal.word_energy(x, 4, 2, 3) == 0.0
    assert signal.share_above(audio_of((0.5, 0), (0.5, 0.3)), SR, 0, 1, 1e-3, 3) == 0.5


def test_burst_in_silence():
    found = signal.speech_in_silence(audio_of((0.1, 0), (0.1, 0.3), (0.8, 0)), SR, 0.0, 1.0)
    assert found and abs(found[0] - 0.1) < 0.011 and abs(found[1] - 0.21) < 0.02
    assert signal.speech_in_silence(audio_of((0.4, 0), (0.05, 0.3), (0.5, 0)), SR, 0.0, 0.95) is None


def test_speech_end_and_edges():
    x = audio_of((0.5, 0), (0.5, 0.3), (0.5, 0))
    assert abs(signal.speech_end(x, SR, 0.2) - 1.0) < 0.011 and signal.speech_end(x, SR, 9.0) is None
    y = signal.edges_normalised(audio_of((1.0, 0), (0.5, 0.3), (0.1, 0)), SR, threshold=0.01)
    assert abs(len(y) / SR - 1.5) < 0.13
    assert signal.edge_silence(np.zeros(2048), SR)[0] == 2048 / SR


def test_silence_ranges_and_cap():
    x = audio_of((0.3, 0.3), (2.0, 0), (0.5, 0.3))
    assert [(round(a / SR, 2), round(b / SR, 2)) for a, b in signal.silence_ranges(x, SR)] == [(0.3, 2.3)]
    assert abs(len(signal.silence_capped(x, SR)) / SR - 1.8) < 0.01
    assert signal.silence_ranges(np.zeros(SR), SR) == [(0, SR)]


@pytest.mark.parametrize(("a", "b"), [(48000, 16000), (44100, 16000), (8000, 16000)])
def test_resampled_tone(a, b):
    y = signal.resampled(np.sin(2 * np.pi * 300 * np.arange(a) / a), a, b)
    want = np.sin(2 * np.pi * 300 * np.arange(b) / b)
    assert len(y) == b and np.abs(y - want)[200:-200].max() < 1e-3


def test_token_spans_and_pauses():
    ids = np.array([0, 0, 5, 5, 0, 0, 0, 0, 7])
    assert signal.token_spans(ids, 0, 0.5) == [(5, 0.09, 0.21), (7, 0.45, 0.5)]
    assert signal.pauses(ids, 0) == [(240, 480, 240)]


# alignment


def brute_cost(a, b, match):
    from functools import lru_cache

    @lru_cache(None)
    def cost(i, j):
        if not i or not j:
            return i + j
        return min(cost(i - 1, j) + 1, cost(i, j - 1) + 1, cost(i - 1, j - 1) + (not match(a[i - 1], b[j - 1])))

    return cost(len(a), len(b))


def test_alignment_costs():
    rng = random.Random(4)
    for _ in range(40):
        a, b = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 3))) for _ in range(rng.randrange(9))], ["".join(rng.choice("abc")) for _ in range(rng.randrange(9))]
        assert sum(i is None or j is None or a[i] != b[j] for i, j in align.fuzzy_pairs(a, b, str.__eq__)) == brute_cost(tuple(a), tuple(b), str.__eq__)
        assert all(a[i] == b[j] for i, j in align.equal_pairs(a, b))
        pairs = align.fuzzy_pairs(a, b, str.__eq__)
        assert [i for i, _ in pairs if i is not None] == list(range(len(a))) and [j for _, j in pairs if j is not None] == list(range(len(b)))


def test_ties_and_repeats():
    assert align.equal_pairs(["a", "a"], ["a"]) == [(1, 0)]
    assert align.fuzzy_pairs(["ai4", "dou1"], ["idol"], align.unit_match()) == [(0, 0), (1, None)]
    assert align.equal_pairs([], ["a"]) == []


def test_hanzi_and_spellings():
    words = [(0, 0.3, "<sp1>"), (0.3, 0.5, "jin1"), (0.5, 0.6, "，"), (0.6, 0.9, "hel"), (0.9, 1.0, "tian1")]
    assert [t for _, _, t in align.hanzi_labels(words, "今，Hello天")] == ["<sp1>", "今", "，", "Hello", "天"]
    assert align.spellings_normalised(words, "今，Hello天")[3][2] == "Hello"
    assert [t for _, _, t in align.hanzi_labels([(0, 1, "jin1"), (1, 2, "tian1")], "天", {"天": "tian1"})] == ["jin1", "天"]


def test_reslicing():
    assert align.resliced(["a", "b"], [(0, 1), (1, 3)], 0, 3) == [(0, 1, "a"), (1, 3, "b")]
    assert align.resliced(["a", "b", "c"], [(0, 1), (1, 3)], 0, 3) == [(0, 1, "a"), (1, 2, "b"), (2, 3, "c")]
    assert align.resliced(["a"], [(0, 1), (1, 3)], 0, 3) == [(0, 3, "a")]
    assert align.resliced(["a", "b"], [], 0, 1) == [(0, 0.5, "a"), (0.5, 1, "b")]
    assert align.resliced(["a", "b"], [(0, 0.01), (0.01, 1)], 0, 1) == [(0.01, 1, "b")]


def test_fragments_stress_and_sync():
    toks = [("jin1", 0, 1), ("he", 1, 2), ("llo", 2, 3), ("tian1", 3, 4)]
    assert align.english_fragments(toks, "今hello天") == [("jin1", 0, 1), ("hello", 1, 3), ("tian1", 3, 4)]
    assert align.stressed(["HH", "AH0", "L", "OW0"], ["HH", "AH0", "L", "OW1"]) == ["HH", "AH0", "L", "OW1"]
    assert align.positional_match(["A", "b", "c"], ["b", "a", "c"]) == [1, None, None]
    assert align.pinyin_synced("jin1 tian1", "<sp1>今，天") == "<sp1> jin1 ， tian1"


# adjustment


def test_start_and_end_move_to_the_sound():
    x = audio_of((0.3, 0), (0.5, 0.3), (0.6, 0))
    tokens, punct, counts = adjust.adjusted([{"word": "ba1", "start_s": 0.1, "end_s": 0.7}], [{"word": "。", "start_s": 0.71, "end_s": 1.0}], x, SR)
    assert abs(tokens[0]["start_s"] - 0.3) < 0.011 and abs(tokens[0]["end_s"] - 0.8) < 0.011
    assert counts["start_adj"] == counts["end_extend"] == counts["punct_adj"] == 1 and punct[0]["start_s"] == tokens[0]["end_s"]
    same = [{"word": "SIGH", "start_s": 0.1, "end_s": 0.7}]
    assert adjust.adjusted(same, [], x, SR)[0] == same


def test_gaps_filled():
    items = [{"word": "a", "start_s": 0.5, "end_s": 2.0}, {"word": "b", "start_s": 1.0, "end_s": 1.5}]
    assert adjust.gaps_filled(items, 2.0) == [(0.0, 0.5, ""), (0.5, 1.0, "a"), (1.0, 1.5, "b"), (1.5, 2.0, "")]


# fusion


def items(*rows):
    return [Item(float(a), float(b), t) for a, b, t in rows]


def spans(made):
    return [(round(i.x0, 3), round(i.x1, 3), i.text) for i in made]


def test_pause_behind_a_word_goes_to_the_punctuation():
    words = items((8.03, 8.27, "jie2"), (8.27, 8.52, "<eps>"), (8.52, 8.70, "shi4"), (8.70, 9.0, "<eps>"))
    phones = items((8.03, 8.1, "j"), (8.1, 8.27, "ie2"), (8.52, 8.6, "sh"), (8.6, 8.7, "i4"))
    tokens, punct = items((8.03, 8.525, "jie2"), (8.52, 8.70, "shi4")), items((8.30, 8.50, "，"), (8.75, 9.0, "。"))
    made, sounds = fusion.snapped(words, phones, tokens, punct)
    made, _ = fusion.punctuation_injected(made, sounds, punct, 9.0)
    assert (8.03, 8.27, "jie2") in spans(made) and (8.27, 8.52, "，") in spans(made) and spans(made)[-1] == (8.7, 9.0, "。")


def test_merged_silence_is_given_back():
    words = items((9.23, 9.58, "zhong3"), (9.58, 9.64, "er4"))
    made, _ = fusion.snapped(words, items((9.23, 9.39, "ong3"), (9.58, 9.64, "er4")), items((9.23, 9.40, "zhong3"), (9.45, 9.63, "er4")), [])
    got = {t: (a, b) for a, b, t in spans(made)}
    assert got["er4"][1] - got["er4"][0] >= 0.06 and got["zhong3"][1] <= got["er4"][0] + 1e-6


def test_short_vocalisation_keeps_the_aligner():
    words = items((1.9, 2.16, "wen4"), (2.16, 2.37, "ti2"), (2.37, 2.45, "BREATHING"))
    made, _ = fusion.snapped(words, items((2.16, 2.2, "t"), (2.2, 2.37, "i2"), (2.37, 2.45, "BREATHING")), items((1.9, 2.13, "wen4"), (2.13, 2.31, "ti2"), (2.31, 2.37, "BREATHING")), [])
    assert [s for s in spans(made) if not s[2].startswith("<sp")][1:] == [(2.16, 2.37, "ti2"), (2.37, 2.45, "BREATHING")]


@pytest.mark.parametrize(("gap", "absorbed"), [(0.2, True), (0.21, False)])
def test_vocalisation_absorbs_gaps_up_to_the_limit(gap, absorbed):
    words = items((0, 1, "ba1"), (1 + gap, 2, "SIGH"))
    made, _ = fusion.snapped(words, [], items((0, 1, "ba1"), (1 + gap, 2, "SIGH")), [])
    assert any(w.silent for w in made) != absorbed


def test_unmatched_word():
    words = items((0, 1, "ba1"), (1, 2, "xx"), (2, 3, "ma1"))
    tokens = items((0, 1, "ba1"), (2, 3, "ma1"))
    assert "xx" not in [w.text for w in fusion.snapped(words, [], tokens, [])[0]]
    assert "xx" in [w.text for w in fusion.snapped(words, [], tokens, [], keep_unmatched=True)[0]]


def test_punctuation_gives_way_to_words():
    made, _ = fusion.punctuation_injected(items((0, 1, "a1"), (1.4, 2, "b1"), (2, 3, "c1")), [], items((0.9, 1.2, "，"), (1.5, 1.6, "！")), 3.0)
    assert spans(made) == [(0, 1, "a1"), (1.4, 2, "b1"), (2, 3, "c1")]
    made, _ = fusion.punctuation_injected(items((0, 1, "a1"), (1.4, 2, "b1")), [], items((0.9, 1.2, "，"), (2.0, 2.1, "。")), 3.0)
    assert spans(made) == [(0, 1, "a1"), (1, 1.4, "，"), (1.4, 2, "b1"), (2, 3, "。")]


def test_labels_and_fragments():
    words = items((0, 1, "<unk>"), (1, 1.5, "hel4"), (1.5, 2, "hello"), (2, 3, "[bracket]"))
    made = fusion.labels_restored(words, items((0, 1, "ba1"), (1, 2, "hello"), (2, 3, "SIGH")))
    assert spans(made) == [(0, 1, "ba1"), (1, 2, "hello"), (2, 3, "SIGH")]


def test_short_silence_by_energy():
    x = audio_of((0.5, 0.3), (0.1, 0.25), (0.5, 0.3))
    phones, words, log = fusion.short_silences_merged(items((0, 0.5, "a"), (0.5, 0.6, "sil"), (0.6, 1.1, "b")), items((0, 0.5, "w"), (0.5, 0.6, "<eps>"), (0.6, 1.1, "v")), x, SR)
    assert spans(phones) == [(0, 0.6, "a"), (0.6, 1.1, "b")] and spans(words) == [(0, 0.6, "w"), (0.6, 1.1, "v")] and len(log) == 1
    quiet = audio_of((0.5, 0.3), (0.1, 0), (0.5, 0.3))
    assert len(fusion.short_silences_merged(items((0, 0.5, "a"), (0.5, 0.6, "sil")), [], quiet, SR)[0]) == 2


def test_short_word_grows_over_a_burst():
    x = audio_of((1.0, 0.3), (0.02, 0), (0.15, 0.3), (0.6, 0))
    words, _, log = fusion.short_words_fixed(items((0, 0.9, "ba1"), (0.9, 1.0, "le5"), (1.0, 1.77, "<sp2>")), [], x, SR)
    assert len(log) == 1 and 1.1 < words[1].x1 < 1.25 and words[2].x0 == words[1].x1


def test_silent_word_moves_and_tail_is_trimmed():
    x = audio_of((0.3, 0), (0.4, 0.3), (0.8, 0))
    moved = fusion.refined(items((0.1, 0.25, "ba1"), (0.8, 1.4, "<sp2>")), x, SR)
    assert abs(moved[0].x0 - 0.3) < 0.011
    trimmed = fusion.refined(items((0.3, 1.2, "ba1"), (1.2, 1.5, "<sp1>")), x, SR)
    assert abs(trimmed[0].x1 - 0.7) < 0.03 and trimmed[1].silent and trimmed[1].x0 == trimmed[0].x1


def test_unexpected_silences():
    words, _, reasons = fusion.unexpected_silences_handled(items((0, 1, "a1"), (1, 1.1, "<sp0>"), (1.1, 2, "b1"), (2, 2.4, "<sp1>"), (2.4, 3, "c1"), (3, 3.4, "<sp1>"), (3.4, 4, "SIGH")), [])
    assert spans(words)[0] == (0, 1.1, "a1") and reasons == ["unexpected_silence"]


def test_lost_punctuation():
    words, (text,) = fusion.lost_punctuation(items((0, 1, "a1"), (1, 1.2, "…"), (2, 2.1, "，")), items((1.1, 1.3, "。"), (2.0, 2.2, "，"), (5, 6, "，")), "甲。乙，丙，丁")
    assert [w.text for w in words] == ["a1", "。", "，"] and text == "甲。乙，丙丁"
    assert [w.text for w in fusion.ellipses_restored(items((1, 2, "…")), items((1.29, 2, "！")))] == ["！"]


def test_vocals_and_ellipses():
    assert spans(fusion.vocal_ellipses_merged(items((0, 1, "SIGH"), (1.01, 1.5, "…"), (1.5, 2, "…")))) == [(0, 2, "SIGH")]
    assert spans(fusion.vocal_ends_restored(items((0, 1, "SIGH"), (1, 2, "a1")), items((0, 1.4, "SIGH")))) == [(0, 1.4, "SIGH"), (1.4, 2, "a1")]
    x = audio_of((0.5, 0.3), (0.2, 0.3), (0.5, 0))
    made = fusion.words_into_ellipses(items((0, 0.5, "ba1"), (0.5, 1.2, "…")), x, SR)
    assert abs(made[0].x1 - 0.7) < 0.02 and made[1].x0 == made[0].x1


def test_pinyin_phones():
    lex = {"ba1": ["b", "a1"], "a1": ["a1"]}
    made = fusion.pinyin_phones(items((0, 1, "ba1"), (1, 2, "Hello"), (2, 3, "<sp9>"), (3, 4, "A1"), (4, 5, "Xx")), items((0, 0.4, "p"), (0.4, 1.2, "a˥"), (1.2, 2, "HH"), (3, 4, "a˥")), lex)
    assert spans(made) == [(0, 0.4, "b"), (0.4, 1, "a1"), (1.2, 2, "en:HH"), (2, 3, "<sp2>"), (3, 4, "a1"), (4, 5, "xx")]


def test_english_phones_applied():
    entry = {"word_text": "hi", "word_start": 1.0, "word_end": 2.0, "phones": [{"phone": "HH", "start": 1.0, "end": 1.4}, {"phone": "AY1", "start": 1.4, "end": 2.0}]}
    made = fusion.english_phones_applied(items((0, 1, "ba1"), (1.1, 2.1, "hi")), items((0, 1, "a1"), (1.1, 2.1, "spn")), [entry])
    assert spans(made) == [(0, 1, "a1"), (1.1, 1.5, "en:HH"), (1.5, 2.1, "en:AY1")]


def test_words_tier_stays_ordered():
    rng = random.Random(7)
    for _ in range(60):
        at, words, tokens, punct = 0.0, [], [], []
        for k in range(rng.randrange(1, 9)):
            d = rng.uniform(0.05, 0.5)
            text = rng.choice(["ba1", "de5", "SIGH", "hello"])
            words.append((at, at + d, text))
            j = rng.uniform(-0.2, 0.2)
            tokens.append((max(0, at + j), max(0, at + j) + d * rng.uniform(0.4, 2.5), text))
            at += d
            if rng.random() < 0.4:
                g = rng.uniform(0.02, 0.7)
                words.append((at, at + g, "<eps>"))
                if rng.random() < 0.6:
                    punct.append((at, at + g * rng.random() + 0.01, "，"))
                at += g
        made, sounds = fusion.snapped(items(*words), [], items(*tokens), items(*punct))
        assert all(a.x1 <= b.x0 + 0.002 + 1e-6 for a, b in zip(made, made[1:], strict=False))
        made, _ = fusion.punctuation_injected(made, sounds, items(*punct), at)
        assert all(i.d > 0 for i in made) and made == sorted(made, key=lambda i: i.x0)


def test_fused_table(spark):
    kind = "dataset string, stem string, words array<struct<xmin:double,xmax:double,text:string>>, phones array<struct<xmin:double,xmax:double,text:string>>, tokens array<struct<xmin:double,xmax:double,text:string>>, punct array<struct<xmin:double,xmax:double,text:string>>, text string, samples array<float>, sample_rate int"
    words = [(0.0, 0.3, "<eps>"), (0.3, 0.7, "ba1"), (0.7, 1.0, "<eps>")]
    good = ("d", "u", words, [(0.3, 0.5, "p"), (0.5, 0.7, "a˥")], [(0.3, 0.7, "ba1")], [(0.72, 0.9, "。")], "八。", [float(x) for x in audio_of((0.3, 0), (0.4, 0.3), (0.3, 0))], SR)
    bad = ("d", "v", [(None, 1.0, "x")], None, None, None, None, None, None)
    empty = ("d", "w", [], None, None, None, None, None, None)
    got = fusion.fused(spark.createDataFrame([good, bad, empty], kind).withColumn("entries", F.expr("map('ba1', array('b', 'a1'))"))).collect()
    assert [r.error is not None for r in got if r.stem == "v"] == [True]
    hanzi = [r.text for r in got if r.stem == "u" and r.tier == "hanzi"]
    assert "八" in hanzi and hanzi[-1] == "。"
    assert [r.text for r in got if r.stem == "u" and r.tier == "raw_text"] == ["八。"]


def test_tokens_and_anchors_without_end(spark, tmp_path):
    from tessella.plans import kernel_queries as kq

    def put(name, kind, *rows):
        spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}.parquet")

    spans = [(0.0, 0.4, "ba1"), (0.4, 0.8, "ma1"), (0.8, 1.2, "da1"), (1.2, 1.6, "<sp1>")]
    put("tier_interval", "interval_id bigint, dataset string, stem string, tier string, ord int, xmin double, xmax double, text string", *[(i, "d", "u", "words", i, *s) for i, s in enumerate(spans)])
    put("ctc_token", "token_id bigint, dataset string, stem string, start_s double, end_s double, word string", (1, "d", "u", 0.0, 0.4, "ba1"), (2, "d", "u", 0.4, None, "ma1"), (3, "d", "u", 0.8, None, "da1"))
    put("ctc_punct", "punct_id bigint, dataset string, stem string, start_s double, end_s double, word string", (1, "d", "u", 0.7, None, "，"), (2, "d", "u", 1.2, None, "。"))
    put("lexicon", "line_no int, token string, phones array<string>", (1, "ba1", ["b", "a1"]))
    u = kq.assembled(spark, str(tmp_path)).first()
    assert [tuple(t) for t in u.tokens] == [(0.0, 0.4, "ba1"), (0.4, 0.7, "ma1"), (0.8, 1.2, "da1")]
    assert [(p.xmin, round(p.xmax, 6), p.text) for p in u.punct] == [(0.7, 0.8, "，"), (1.2, 1.26, "。")]
    for query in (kq.g2_snapped, kq.g8_fused):
        made = query(spark, str(tmp_path))
        made = made.where("tier = 'words'") if "tier" in made.columns else made
        assert {"ba1", "ma1", "da1"} <= {r.text for r in made.collect()}
    assert "。" in {r.text for r in kq.g1_punctuated(spark, str(tmp_path)).collect()}


def test_fused_table_with_english_phones(spark):
    spans_kind = "array<struct<xmin:double,xmax:double,text:string>>"
    entry_kind = "array<struct<word_text:string,word_start:double,word_end:double,en_word_start:double,en_word_end:double,phones:array<struct<phone:string,start:double,end:double>>>>"
    kind = f"dataset string, stem string, words {spans_kind}, phones {spans_kind}, tokens {spans_kind}, punct {spans_kind}, text string, en_words {entry_kind}"
    words = [(0.0, 0.5, "ba1"), (0.5, 1.0, "hi")]
    entries = [("hi", 0.5, 1.0, 0.5, 1.0, [("HH", 0.5, 0.7), ("AY1", 0.7, 1.0)]), ("no", 3.0, 3.2, None, None, [])]
    row = ("d", "u", words, [(0.0, 0.2, "p"), (0.2, 0.5, "a˥"), (0.5, 1.0, "spn")], words, [], "八 hi", entries)
    bare = (*row[:1], "v", *row[2:7], None)
    got = fusion.fused(spark.createDataFrame([row, bare], kind).withColumn("entries", F.expr("map('ba1', array('b', 'a1'))"))).collect()
    assert not [r.error for r in got if r.error]
    phones = {s: [r.text for r in got if r.stem == s and r.tier == "pinyin_phones"] for s in "uv"}
    assert phones["u"] == ["b", "a1", "en:HH", "en:AY1"] and "en:HH" not in phones["v"]
