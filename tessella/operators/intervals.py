"""Interval algebra over tiers: projections and filters, overlap joins, neighbour operators, islands.

Every operator takes rows keyed by utterance and partitions by that key, so that all windows of a plan share one
exchange. Time order is (xmin, xmax, interval_id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tessella.functions import tokens as tk

UTT = ("dataset", "stem")


def by_time(*keys: str) -> WindowSpec:
    return Window.partitionBy(*(keys or UTT)).orderBy("xmin", "xmax", "interval_id")


def tiers(intervals: DataFrame, *names: str, bounded: bool = True) -> DataFrame:
    """Rows of the named tiers in any letter case, each id once; the tier's name in lower case.

    Rows without both bounds are left out, unless ``bounded`` is false, for operators that look at texts only.

    The one exchange, by utterance, also serves the windows that follow.
    """
    t = F.lower("tier").alias("tier")
    rows = intervals.select("interval_id", *UTT, t, "ord", "xmin", "xmax", "text")
    if bounded:
        rows = rows.where("xmin is not null and xmax is not null")
    if names:
        rows = rows.where(F.col("tier").isin(*names))
    return rows.repartition(*UTT).distinct()


def duration() -> Column:
    return F.col("xmax") - F.col("xmin")


# B: projections and filters


def relabelled(rows: DataFrame) -> DataFrame:
    """Silences of every tier bear the grade of their duration."""
    return rows.withColumn("text", F.when(tk.is_silence(F.col("text")), tk.silence_grade(duration())).otherwise(F.col("text")))


def without_tombstones(rows: DataFrame, least: float = 0.001) -> DataFrame:
    return rows.where(F.col("xmax") > F.col("xmin") + least)


def without_empty(rows: DataFrame, least: float = 0.001) -> DataFrame:
    """Rows that last, or whose text is blank."""
    return rows.where((duration() > least) | (tk.stripped(F.col("text")) == ""))


def canonical_case(rows: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Texts in the lexicon's spelling, the first line of each case-folded token deciding."""
    first = lexicon.where("token is not null").groupBy(F.lower("token").alias("_low")).agg(F.min_by("token", "line_no").alias("_token"))
    return rows.withColumn("_low", F.lower("text")).join(first, "_low", "left").withColumn("text", F.coalesce("_token", "text")).drop("_low", "_token")


def finalised(rows: DataFrame) -> DataFrame:
    """Vocalisations marked in all tiers; the raw text led by ``<sp1>``; the first graded silence of the other tiers ``<sp1>``."""
    from tessella.functions.text import vocalisations_marked

    marked = rows.withColumn("text", vocalisations_marked(F.col("text")))
    graded = F.col("text").rlike("^<sp[0-9]>")
    w = by_time(*UTT, "tier")
    first = F.sum(graded.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    place = F.row_number().over(w)
    raw = (F.col("tier") == "raw_text") & (F.col("_place") == 1) & (tk.stripped(F.col("text")) != "") & ~F.col("text").startswith("<sp")
    other = (F.col("tier") != "raw_text") & graded & (F.col("_seen") == 1)
    out = marked.withColumn("_seen", first).withColumn("_place", place)
    text = F.when(raw, F.concat(F.lit("<sp1>"), "text")).when(other, F.regexp_replace("text", "^<sp[0-9]>", "<sp1>")).otherwise(F.col("text"))
    return out.withColumn("text", text).drop("_seen", "_place")


#: Order of the tiers written.
TIER_ORDER = ("raw_text", "pinyin", "hanzi", "words", "pinyin_phones")


def ordered_tiers(rows: DataFrame) -> DataFrame:
    """Tiers other than those written are dropped, and the rest numbered in the order of writing."""
    order = F.array_position(F.array(*map(F.lit, TIER_ORDER)), F.col("tier"))
    return rows.where(F.col("tier").isin(*TIER_ORDER)).withColumn("tier_ord", order.cast("int"))


# C: joins


def paired(a: DataFrame, b: DataFrame, condition: Column, prefix: tuple[str, str] = ("a_", "b_"), how: str = "inner") -> DataFrame:
    """Rows of two tiers of an utterance for which ``condition`` holds over prefixed columns.

    An equi-join on the utterance with the inequality as residual: no product across utterances.
    """
    left = a.select(*UTT, *[F.col(c).alias(prefix[0] + c) for c in a.columns if c not in UTT])
    right = b.select(*[F.col(c).alias("_" + c) for c in UTT], *[F.col(c).alias(prefix[1] + c) for c in b.columns if c not in UTT])
    keys = (F.col("dataset") == F.col("_dataset")) & (F.col("stem") == F.col("_stem"))
    return left.join(right, keys & condition, how).drop("_dataset", "_stem")


def bucketed_pairs(a: DataFrame, b: DataFrame, width: float, slack: float = 0.0) -> DataFrame:
    """Overlapping pairs of very long utterances: rows are cut into time buckets and joined per bucket, each pair kept
    where it first meets. For entities whose rows would not fit one task's sort."""
    span = lambda lo, hi: F.explode(F.sequence(F.floor((F.col(lo) - slack) / width), F.floor((F.col(hi) + slack) / width)))
    left = a.select(*UTT, *[F.col(c).alias("a_" + c) for c in a.columns if c not in UTT]).withColumn("bucket", span("a_xmin", "a_xmax"))
    right = b.select(*UTT, *[F.col(c).alias("b_" + c) for c in b.columns if c not in UTT]).withColumn("bucket", span("b_xmin", "b_xmax"))
    met = F.floor((F.greatest("a_xmin", "b_xmin")) / width)
    pairs = left.join(right, [*UTT, "bucket"]).where((F.col("a_xmax") > F.col("b_xmin")) & (F.col("a_xmin") < F.col("b_xmax")))
    return pairs.where(F.col("bucket") == met).drop("bucket")


def parts_in_words(words: DataFrame, parts: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Parts within words, clipped to them; a part that straddles two words goes to the earlier one only."""
    touch = (F.col("b_xmin") < F.col("a_xmax") - tolerance) & (F.col("b_xmax") > F.col("a_xmin") + tolerance)
    pairs = paired(words.select(*UTT, "interval_id", "xmin", "xmax", "text"), parts.select(*UTT, "interval_id", "xmin", "xmax", "text"), touch)
    first = pairs.groupBy(*UTT, "b_interval_id").agg(F.min_by(F.struct("a_interval_id", "a_xmin", "a_xmax", "a_text", "b_xmin", "b_xmax", "b_text"), F.struct("a_xmin", "a_interval_id")).alias("m"))
    return first.select(
        *UTT, F.col("m.a_interval_id").alias("word_id"), F.col("m.a_text").alias("word"), F.col("b_interval_id").alias("part_id"), F.col("m.b_text").alias("part"),
        F.greatest("m.a_xmin", "m.b_xmin").alias("xmin"), F.least("m.a_xmax", "m.b_xmax").alias("xmax"),
    )


def best_overlap(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """For each row the anchor (ord, xmin, xmax, word) that overlaps it most, the earliest on ties; rows without are left out."""
    touch = (F.col("a_xmax") > F.col("b_xmin")) & (F.col("a_xmin") < F.col("b_xmax"))
    pairs = paired(rows, anchors, touch)
    shared = F.least("a_xmax", "b_xmax") - F.greatest("a_xmin", "b_xmin")
    best = pairs.groupBy(*UTT, "a_interval_id").agg(F.max_by(F.struct("a_text", "b_interval_id", "b_word"), F.struct(F.round(shared, 6), -F.col("b_interval_id"))).alias("m"))
    return best.select(*UTT, F.col("a_interval_id").alias("interval_id"), F.col("m.a_text").alias("text"), F.col("m.b_interval_id").alias("anchor_id"), F.col("m.b_word").alias("word"))


def restored_labels(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """Unknown and bracketed words take the anchor's word where it is a vocalisation or English, pinyin where it is English."""
    best = best_overlap(rows.where((F.col("text") == "<unk>") | F.col("text").rlike(r"^\[.*\]$") | tk.is_pinyin(F.col("text"))), anchors)
    english, vocal = tk.is_english(F.col("word")), tk.is_vocalisation(F.col("word"))
    take = F.when(F.col("text") == "<unk>", F.lit(True)).when(F.col("text").startswith("["), english | vocal).otherwise(english)
    return best.where(take).select(*UTT, "interval_id", "text", F.col("word").alias("restored"))


def within_any(rows: DataFrame, ranges: DataFrame, tolerance: float) -> DataFrame:
    """Rows that lie in some range, give or take the tolerance."""
    inside = (F.col("a_xmin") >= F.col("b_xmin") - tolerance) & (F.col("a_xmax") <= F.col("b_xmax") + tolerance)
    return _back(paired(rows, ranges, inside, how="left_semi"))


def outside_all(rows: DataFrame, ranges: DataFrame, tolerance: float) -> DataFrame:
    """Interval subtraction: rows that lie in no range."""
    inside = (F.col("a_xmin") >= F.col("b_xmin") - tolerance) & (F.col("a_xmax") <= F.col("b_xmax") + tolerance)
    return _back(paired(rows, ranges, inside, how="left_anti"))


def overlapping_none(rows: DataFrame, others: DataFrame) -> DataFrame:
    touch = (F.col("a_xmax") > F.col("b_xmin")) & (F.col("a_xmin") < F.col("b_xmax"))
    return _back(paired(rows, others, touch, how="left_anti"))


def _back(pairs: DataFrame) -> DataFrame:
    return pairs.select(*[F.col(c).alias(c.removeprefix("a_")) for c in pairs.columns if not c.startswith("_")])


def covered_share(words: DataFrame, parts: DataFrame, tolerance: float = 0.002) -> DataFrame:
    """Share of each word's duration that lies under parts fully inside it."""
    inside = (F.col("b_xmin") >= F.col("a_xmin") - tolerance) & (F.col("b_xmax") <= F.col("a_xmax") + tolerance)
    pairs = paired(words.where("xmax > xmin"), parts, inside, how="left")
    part = F.coalesce(F.sum(F.col("b_xmax") - F.col("b_xmin")), F.lit(0.0))
    return pairs.groupBy(*UTT, F.col("a_interval_id").alias("interval_id")).agg((part / F.first(F.col("a_xmax") - F.col("a_xmin"))).alias("share"))


def nearest_entry(rows: DataFrame, entries: DataFrame, round_to: float = 0.5, within: float = 1.0) -> DataFrame:
    """The entry of the same word whose start rounds alike, else the first whose start is less than ``within`` away."""
    same = (F.lower("a_text") == F.lower("b_word")) & (F.abs(F.col("a_xmin") - F.col("b_xmin")) < within)
    pairs = paired(rows, entries, same)
    alike = F.floor(F.col("a_xmin") / round_to + 0.5) == F.floor(F.col("b_xmin") / round_to + 0.5)
    best = pairs.groupBy(*UTT, "a_interval_id").agg(F.min_by("b_interval_id", F.struct((~alike).cast("int"), "b_xmin", "b_interval_id")).alias("entry_id"))
    return best.select(*UTT, F.col("a_interval_id").alias("interval_id"), "entry_id")


# D: neighbours and islands


def islands(rows: DataFrame, new_island: Column, window: WindowSpec, name: str = "island") -> DataFrame:
    """Numbers the stretches that begin where ``new_island`` holds; it may use ``lag`` over ``window``."""
    flagged = rows.withColumn("_new", new_island.cast("int"))
    return flagged.withColumn(name, F.sum("_new").over(window.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def same_text_merged(rows: DataFrame, gap: float = 0.002) -> DataFrame:
    """Neighbours with one text and next to no gap become one interval."""
    w = by_time(*UTT, "tier")
    differs = (F.col("text") != F.lag("text").over(w)) | (F.col("xmin") - F.lag("xmax").over(w) >= gap)
    marked = islands(rows, F.coalesce(differs, F.lit(True)), w)
    return marked.groupBy(*UTT, "tier", "island").agg(F.min("interval_id").alias("first_id"), F.min("xmin").alias("xmin"), F.max("xmax").alias("xmax"), F.min("text").alias("text"), F.count(F.lit(1)).alias("n")).drop("island")


def short_silences(rows: DataFrame, below: float = 0.2) -> DataFrame:
    """Short silences behind a sounding interval, with that interval's id, which absorbs them."""
    w = by_time(*UTT, "tier")
    sil, before = tk.is_silence(F.col("text")), F.lag(F.struct("interval_id", tk.is_silence(F.col("text")).alias("sil"))).over(w)
    out = rows.withColumn("_before", before).where(sil & (duration() < below) & ~F.col("_before.sil"))
    return out.select(*UTT, "tier", "interval_id", F.col("_before.interval_id").alias("into_id"), F.col("xmax").alias("new_xmax"))


def short_words(rows: DataFrame, below: float = 0.25, silence: float = 0.4) -> DataFrame:
    """Function words squeezed before a long silence: candidates for lengthening."""
    w = by_time(*UTT, "tier")
    bare = F.regexp_replace("text", "[0-9]+$", "")
    short = tuple(dict.fromkeys([*tk.SHORT_WORDS, *[s.rstrip("12345") for s in tk.SHORT_WORDS]]))
    nxt = F.lead(F.struct("xmin", "xmax", "text")).over(w)
    out = rows.withColumn("_next", nxt).where(bare.isin(*short) & (duration() < below))
    return out.where(tk.is_silence(F.col("_next.text")) & (F.col("_next.xmax") - F.col("_next.xmin") >= silence)).select(*UTT, "interval_id", "text", "xmin", "xmax", F.col("_next.xmax").alias("silence_end"))


def gap_events(rows: DataFrame) -> DataFrame:
    """Gaps between neighbouring words of an utterance with what lies in them: the first silence, and whether there is punctuation.

    (dataset, stem, k, before, after, silence, has_punct); k counts the words from 1.
    """
    kind = F.when(tk.is_silence(F.col("text")), "silence").when(tk.is_punct(F.col("text")), "punct").otherwise("word")
    w = by_time()
    numbered = rows.withColumn("kind", kind).withColumn("k", F.sum((F.col("kind") == "word").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    seen = numbered.groupBy(*UTT, "k").agg(
        F.min_by(F.when(F.col("kind") == "word", F.col("text")), F.when(F.col("kind") == "word", F.col("xmin"))).alias("before"),
        F.min_by(F.when(F.col("kind") == "silence", tk.silence_grade(duration())), F.when(F.col("kind") == "silence", F.struct("xmin", "xmax", "interval_id"))).alias("silence"),
        F.max(F.col("kind") == "punct").alias("has_punct"),
    )
    after = F.lead("before").over(Window.partitionBy(*UTT).orderBy("k"))
    return seen.withColumn("after", after).where("k >= 1 and after is not null")


def unexpected_silences(rows: DataFrame) -> DataFrame:
    """Graded silences of 0.2 s or more between words without punctuation, neither neighbour English nor a vocalisation."""
    foreign = lambda c: tk.is_english(F.col(c)) | tk.is_vocalisation(F.col(c))
    gaps = gap_events(rows)
    return gaps.where(F.col("silence").isin("<sp1>", "<sp2>", "<sp3>") & ~F.col("has_punct") & ~foreign("before") & ~foreign("after"))


def cross_checked_text(rows: DataFrame) -> DataFrame:
    """Each utterance's words with ``[sp]`` in gaps that have silence but no punctuation, and with the punctuation of
    gaps that have silence; punctuation without silence is dropped."""
    kind = F.when(tk.is_silence(F.col("text")), "silence").when(tk.is_punct(F.col("text")), "punct").otherwise("word")
    w = by_time()
    numbered = rows.withColumn("kind", kind).withColumn("k", F.sum((F.col("kind") == "word").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    g = Window.partitionBy(*UTT, "k")
    facts = numbered.withColumn("has_sil", F.max(F.col("kind") == "silence").over(g)).withColumn("has_punct", F.max(F.col("kind") == "punct").over(g)).withColumn("last_k", F.max("k").over(Window.partitionBy(*UTT)))
    inner = (F.col("k") >= 1) & (F.col("k") < F.col("last_k"))
    piece = F.when(F.col("kind") == "word", F.concat("text", F.when(inner & F.col("has_sil") & ~F.col("has_punct"), " [sp]").otherwise(""))).when((F.col("kind") == "punct") & (F.col("has_sil") | ~inner), F.col("text"))
    pieces = facts.withColumn("piece", piece).where("piece is not null")
    listed = F.array_sort(F.collect_list(F.struct("xmin", "xmax", "interval_id", "piece")))
    return pieces.groupBy(*UTT).agg(F.array_join(F.transform(listed, lambda x: x["piece"]), " ").alias("text"))


def vocal_ellipses(rows: DataFrame, gap: float = 0.02) -> DataFrame:
    """Vocalisations directly followed by an ellipsis, which they absorb."""
    w = by_time(*UTT, "tier")
    nxt = F.lead(F.struct("interval_id", "xmin", "xmax", "text")).over(w)
    out = rows.withColumn("_n", nxt).where(tk.is_vocalisation(F.col("text")) & (F.col("_n.text") == "…") & (F.col("_n.xmin") - F.col("xmax") < gap))
    return out.select(*UTT, "interval_id", F.col("_n.interval_id").alias("absorbed_id"), "xmin", F.col("_n.xmax").alias("xmax"), "text")


def label_runs(tokens: DataFrame, keep: Column, same: Column | None = None) -> DataFrame:
    """Consecutive tokens for which ``keep`` holds and that continue the one before by ``same`` (default: equal words):
    (dataset, stem, first_id, n, xmin, xmax, words)."""
    w = by_time()
    text = F.col("text")
    cont = keep & F.coalesce(F.lag(keep).over(w), F.lit(False)) & F.coalesce(same if same is not None else text == F.lag(text).over(w), F.lit(False))
    marked = islands(tokens, ~cont, w).where(keep)
    listed = F.array_sort(F.collect_list(F.struct("xmin", "xmax", "interval_id", "text")))
    return marked.groupBy(*UTT, "island").agg(
        F.min_by("interval_id", F.struct("xmin", "xmax", "interval_id")).alias("first_id"), F.count(F.lit(1)).alias("n"), F.min("xmin").alias("xmin"), F.max("xmax").alias("xmax"),
        F.array_join(F.transform(listed, lambda x: x["text"]), "").alias("joined"),
    ).drop("island")


def name_pairs(tokens: DataFrame) -> DataFrame:
    """Pairs of the name's two fragments, taken from the left without overlap, with the span they cover."""
    w = by_time()
    nxt = F.lead(F.struct("interval_id", "xmax", "text")).over(w)
    hits = tokens.withColumn("_n", nxt).where(F.col("text").rlike("^rui[0-5]$") & F.col("_n.text").rlike("^y?a[0-5]$"))
    return hits.select(*UTT, "interval_id", F.col("_n.interval_id").alias("second_id"), "xmin", F.col("_n.xmax").alias("xmax"), F.lit("ria").alias("text"))


def next_start_ends(items: DataFrame, epsilon: float = 0.001) -> DataFrame:
    """Every item ends at the first start of its utterance that is later by more than ``epsilon``; the last keeps its end."""
    us = F.round(F.col("xmin") * 1_000_000).cast("bigint")
    # from the last backward, so that the frame only grows and each row costs the same
    w = Window.partitionBy(*UTT).orderBy(F.desc("_us")).rangeBetween(Window.unboundedPreceding, -(int(epsilon * 1_000_000) + 1))
    return items.withColumn("_us", us).withColumn("new_xmax", F.coalesce(F.min("xmin").over(w), "xmax")).drop("_us")


def ended(items: DataFrame, mark: float = 0.060) -> DataFrame:
    """Items without end get one: the next start of their utterance as in ``next_start_ends``; without a later start an
    item of kind ``punct`` lasts ``mark`` seconds, as anchors that end before they start do, and a token ends at its start."""
    last = F.when(F.col("kind") == "punct", F.col("xmin") + mark).otherwise(F.col("xmin"))
    return next_start_ends(items).withColumn("xmax", F.coalesce("xmax", "new_xmax", last)).drop("new_xmax")


def filled_gaps(items: DataFrame, above: float = 0.005, extend: bool = True) -> DataFrame:
    """Items and, as rows of empty text, the gaps before, between and behind them up to ``utt_end``. With ``extend`` each item
    reaches up to the next one's start, so that gaps are left before the first and behind the last only."""
    w = by_time()
    ends = items.withColumn("_next", F.lead("xmin").over(w)).withColumn("_first", F.row_number().over(w) == 1)
    stop = F.coalesce("_next", "xmax") if extend else F.coalesce(F.least("xmax", "_next"), "xmax")
    spans = F.array(
        F.when(F.col("_first") & (F.col("xmin") > above), F.struct(F.lit(0.0).alias("xmin"), F.col("xmin").alias("xmax"), F.lit("").alias("text"))),
        F.struct("xmin", stop.alias("xmax"), "text"),
        F.when(F.coalesce("_next", "utt_end") - stop > above, F.struct(stop.alias("xmin"), F.coalesce("_next", "utt_end").alias("xmax"), F.lit("").alias("text"))),
    )
    return ends.select(*UTT, F.explode(F.filter(spans, lambda s: s.isNotNull())).alias("s")).select(*UTT, "s.*")


def two_tiers(items: DataFrame, pauses: DataFrame, ends: DataFrame) -> DataFrame:
    """Rows (dataset, stem, tier_ord, tier, ord, xmin, xmax, text) of a grid with the tiers ``words``, of items up to the next start, and
    ``pauses``, of (dataset, stem, start_ms, end_ms, duration_ms) labelled by their length; ``ends`` has xmax of each utterance.

    An utterance without items has no words tier, and one without pauses a single empty interval.
    """
    until = ends.select(*UTT, F.col("xmax").alias("utt_end"))
    words = filled_gaps(items.join(until, [*UTT])).withColumn("tier", F.lit("words"))
    held = pauses.select(*UTT, F.col("start_ms").alias("interval_id"), (F.col("start_ms") / 1000).alias("xmin"), (F.col("end_ms") / 1000).alias("xmax"), F.concat(F.col("duration_ms").cast("string"), F.lit("ms")).alias("text"))
    quiet = filled_gaps(held.join(until, [*UTT]), extend=False)
    none = until.join(held.select(*UTT).distinct(), [*UTT], "left_anti").select(*UTT, F.lit(0.0).alias("xmin"), F.col("utt_end").alias("xmax"), F.lit("").alias("text"))
    rows = words.unionByName(quiet.unionByName(none).withColumn("tier", F.lit("pauses")))
    place = Window.partitionBy(*UTT, "tier").orderBy("xmin", "xmax", "text")
    return rows.select(*UTT, F.when(F.col("tier") == "words", 1).otherwise(2).alias("tier_ord"), "tier", (F.row_number().over(place) - 1).alias("ord"), "xmin", "xmax", "text")


def word_segments(tokens: DataFrame, max_gap: float = 0.35) -> DataFrame:
    """Segments of consecutive English words: a gap of ``max_gap`` or more splits, other words in between do not."""
    english = tokens.where(tk.is_english(F.col("text")))
    w = by_time()
    marked = islands(english, F.coalesce(F.col("xmin") - F.lag("xmax").over(w) >= max_gap, F.lit(True)), w, "segment")
    listed = F.array_sort(F.collect_list(F.struct("xmin", "xmax", "interval_id", "text")))
    return marked.groupBy(*UTT, "segment").agg(F.min("xmin").alias("xmin"), F.max_by("xmax", F.struct("xmin", "interval_id")).alias("xmax"), F.count(F.lit(1)).alias("words"), F.array_join(F.transform(listed, lambda x: x["text"]), " ").alias("text"))


def padded_segments(segments: DataFrame, audio: DataFrame, padding: float = 0.05, least: float = 0.2) -> DataFrame:
    """Segments widened by ``padding`` within the utterance; those shorter than ``least`` are marked as fallbacks instead."""
    out = segments.join(audio.select(*UTT, F.col("xmax").alias("_end")), list(UTT))
    short = F.col("xmax") - F.col("xmin") < least
    return out.select(
        *UTT, "segment", "words", short.alias("fallback"), F.when(~short, F.greatest(F.lit(0.0), F.col("xmin") - padding)).alias("offset"), F.when(~short, F.least("_end", F.col("xmax") + padding)).alias("stop"),
    )


def first_last(rows: DataFrame, *keys: str) -> DataFrame:
    """First and last row of each group in time."""
    order = F.struct("xmin", "xmax", "interval_id")
    return rows.groupBy(*keys).agg(F.min_by("interval_id", order).alias("first_id"), F.max_by("interval_id", order).alias("last_id"), F.count(F.lit(1)).alias("n"))
