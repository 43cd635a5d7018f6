import re
from collections import defaultdict

import pytest

from tessella import plans, queries

plans.register()


def by_utterance(rows, *more):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (*(r[k] for k in ("dataset", "stem", *more)), r["ord"])):
        out[(*(r[k] for k in ("dataset", "stem", *more)),)].append(r)
    return out


def words_of(duck):
    sql = "SELECT DISTINCT interval_id, dataset, stem, xmin, xmax, text FROM tier_interval WHERE lower(tier) = 'words' AND xmax > xmin AND text IS NOT NULL"
    out = defaultdict(list)
    for _, dataset, stem, *w in sorted(duck.execute(sql).fetchall(), key=lambda r: r[3:]):
        out[dataset, stem].append(tuple(w))
    return out


def snapped(rows, duck):
    """Words, silences and marks aside, keep their texts and order, few give way, and each ends after it starts."""
    got, want = by_utterance(rows), words_of(duck)
    bare = lambda ws: [t for t in ws if t[:1].isalpha()]
    pairs = [(bare([r["text"] for r in got[u]]), iter(bare([t for _, _, t in want[u]]))) for u in want]
    kept = all(all(t in left for t in mine) for mine, left in pairs)  # a subsequence
    few = sum(len(mine) for mine, _ in pairs) >= 0.99 * sum(len(bare([t for _, _, t in ws])) for ws in want.values())
    return set(got) == set(want) and kept and few and all(r["xmin"] < r["xmax"] for r in rows)


def punctuated(rows, duck):
    """Every utterance is there, in order of time, and anchors stand among the words of most that have any."""
    got = by_utterance(rows)
    ordered = all(a["xmin"] <= b["xmin"] for rs in got.values() for a, b in zip(rs, rs[1:], strict=False))
    anchored = {(d, s) for d, s in duck.execute("SELECT DISTINCT dataset, stem FROM ctc_punct WHERE start_s IS NOT NULL").fetchall()} & set(got)
    with_marks = {u for u in anchored if any(r["kind"] == "punct" or r["text"][:1] in "，。！？、；：…" for r in got[u])}
    return set(got) == set(words_of(duck)) and ordered and len(with_marks) >= 0.9 * len(anchored)


def fused(rows, duck):
    """No utterance fails; each has its tiers, numbered from 0 in order of time, hanzi for its words and one raw text."""
    tiers = by_utterance(rows, "tier")
    whole = {u[:2] for u in tiers} == set(words_of(duck)) and all(r["error"] is None for r in rows)
    numbered = all([r["ord"] for r in rs] == list(range(len(rs))) for rs in tiers.values())
    lasting = all(r["xmin"] <= r["xmax"] for r in rows)
    raw = all(len(rs) == 1 and re.sub("<sp[0-9]>", "", rs[0]["text"]) == "".join(h["text"] for h in tiers.get((*u[:2], "hanzi"), []) if not h["text"].startswith("<sp") and h["text"].strip()) for u, rs in tiers.items() if u[2] == "raw_text")
    return whole and numbered and lasting and raw


def piped(rows, duck):
    """As ``fused``, for utterances of complete records only."""
    tiers = by_utterance(rows, "tier")
    known = set(words_of(duck))
    return 0 < len({u[:2] for u in tiers}) < len(known) and {u[:2] for u in tiers} <= known and all(r["error"] is None and r["xmin"] <= r["xmax"] for r in rows)


def statuses(rows, duck):
    """Utterances once, each with a status that lists its reasons."""
    listed = all((r["status"] == "ok") == (r["distinct_reasons"] == "") and set(r["distinct_reasons"].split(",")) <= {"", *"pinyin_in_text incomplete_tiers tier_desync misaligned_phones sp3 mid_sp unexpected_silence bgm_suspect".split()} for r in rows)
    return listed and len({(r["dataset"], r["stem"]) for r in rows}) == len(rows)


def ellipses(rows, duck):
    """The same by a chain of replacements in plain Python."""
    mark, label = "[，。！？、；：,.!?;:]", r"\[([A-Za-z][^\]]*?)\]"
    chain = [(f"…({mark})", r"\1"), (f"({mark})…", r"\1"), (f"({mark})([A-Z][A-Z0-9-]*[A-Z0-9])…", r"\1\2"), ("…{2,}", "…"), (r"^((?:<\|[^|]+\|>|\[[^\]]+\])*)…+", r"\1")]
    chain += [(label + r"\s*([，。！？、；：…,.!?;:\-]+)\s*\[\1\]", r"\2[\1]"), (label + r"\s+\[\1\]", r"[\1]"), (r"[ \t\n\x0b\f\r]+", " "), (r"^ +| +$", ""), (r"\b([A-Z][A-Z0-9-]+) \1\b", r"\1")]
    want = {}
    for ann, text in duck.execute("SELECT ann_id, arg_max(raw_text, annotated_at) FROM nvv_annotations WHERE raw_text IS NOT NULL GROUP BY 1").fetchall():
        for pattern, to in chain:
            text = re.sub(pattern, to, text)
        want[ann] = text
    return {r["ann_id"]: r["text"] for r in rows} == want


def moved(rows, duck):
    """All tokens are there once; starts only move later, and by no more than is searched; some bounds move."""
    tokens = [r for r in rows if r["kind"] == "tokens"]
    (n,) = duck.execute("SELECT count(DISTINCT token_id) FROM ctc_token JOIN (SELECT DISTINCT dataset, stem FROM tier_interval WHERE lower(tier) = 'words' AND xmax > xmin AND text IS NOT NULL) USING (dataset, stem) WHERE start_s IS NOT NULL AND word IS NOT NULL").fetchone()
    starts = all(0 <= r["start_s"] - r["old_start"] + 1e-9 <= 0.42 for r in tokens)
    return len(tokens) == n and starts and any(r["start_s"] != r["old_start"] for r in tokens) and any(r["end_s"] != r["old_end"] for r in tokens)


def totals(rows, duck):
    """Both kinds have as many starts as ends."""
    n = {(k, side): sum(r["n"] for r in rows if (r["kind"], r["side"]) == (k, side)) for k in ("tokens", "punct") for side in ("start", "end")}
    return all(n[k, "start"] == n[k, "end"] > 0 for k in ("tokens", "punct")) and any(r["moved"] != "same" for r in rows)


HOLDS = {"l9_ctc_ready": piped, "l9_statuses": statuses, "g1_punctuated": punctuated, "g2_snapped": snapped, "g8_fused": fused, "g8_heard": fused, "i9_ellipses": ellipses, "e3_adjusted_bounds": moved, "e6_adjust_totals": totals}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(name, agree):
    assert agree(queries.QUERIES[name], queries.SQL.get(name), HOLDS.get(name))


def test_entry(spark, small):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["dataset", "stem", "tier", "kind", "from_ms", "to_ms"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
