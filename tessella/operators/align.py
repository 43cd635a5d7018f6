"""Alignment of token sequences, and what is built on it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella.functions.text import word_units
from tessella.functions.tokens import ENGLISH_VOWELS, py_grade, py_pinyin, py_punct, py_silence, py_vocalisation, py_word_like

Match = Callable[[str, str], bool]


#: Codes of the steps that lead to a prefix at least cost.
PAIR, SKIP_A, SKIP_B = 0, 1, 2


def _numbered(items: Sequence[str]) -> tuple[list[str], np.ndarray]:
    """Distinct items, and each item as the number of its own."""
    numbers: dict[str, int] = {}
    places = np.array([numbers.setdefault(x, len(numbers)) for x in items], np.int64)
    return list(numbers), places


def matches(a: Sequence[str], b: Sequence[str], match: Match) -> Callable[[int], np.ndarray]:
    """Gives for a place in ``a`` which places of ``b`` match; distinct pairs are compared once."""
    (left, of_a), (right, of_b) = _numbered(a), _numbered(b)
    known: dict[int, np.ndarray] = {}

    def row(i: int) -> np.ndarray:
        k = int(of_a[i])
        if k not in known:
            known[k] = np.fromiter((match(left[k], y) for y in right), bool, len(right))
        return known[k][of_b]

    return row


def steps(n: int, m: int, same: Callable[[int], np.ndarray], order: tuple[int, int, int]) -> Iterator[int]:
    """Steps of the global alignment at unit costs, from the end back; of several the one that is first in ``order``.

    Costs are kept for one row. Of each cell two bits stay, whether the first and the second step of the order lead
    there, so that two sequences of ten thousand take 25 MB.
    """
    bits = [np.empty((n + 1, (m + 8) // 8), np.uint8) for _ in order[:2]]
    cost, ramp = np.arange(m + 1), np.arange(m + 1)
    for i in range(n + 1):
        new = np.full(m + 1, n + m + 1)
        leads = np.zeros((3, m + 1), bool)
        if i:
            pair, skip = cost[:-1] + ~same(i - 1), cost + 1
            new[1:] = pair
            new = np.minimum(new, skip)
            new = np.minimum.accumulate(new - ramp) + ramp
            leads[PAIR, 1:], leads[SKIP_A] = new[1:] == pair, new == skip
        else:
            new = ramp.copy()
        leads[SKIP_B, 1:] = new[1:] == new[:-1] + 1
        for kept, step in zip(bits, order[:2], strict=True):
            kept[i] = np.packbits(leads[step])
        cost = new
    i, j = n, m
    while i or j:
        step = next((s for kept, s in zip(bits, order[:2], strict=True) if kept[i, j >> 3] >> (7 - (j & 7)) & 1), order[2])
        yield step
        i, j = i - (step != SKIP_B), j - (step != SKIP_A)


def equal_pairs(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
    """Global alignment by equality; the pairs that are equal. On ties the diagonal is preferred, then a gap in ``b``."""
    i, j, out = len(a), len(b), []
    for step in steps(i, j, matches(a, b, str.__eq__), (PAIR, SKIP_A, SKIP_B)):
        i, j = i - (step != SKIP_B), j - (step != SKIP_A)
        if step == PAIR and a[i] == b[j]:
            out.append((i, j))
    return out[::-1]


def fuzzy_pairs(a: Sequence[str], b: Sequence[str], match: Match) -> list[tuple[int | None, int | None]]:
    """Global alignment by ``match`` with all gaps; on ties a gap in ``b`` is preferred, then one in ``a``."""
    i, j, out = len(a), len(b), []
    for step in steps(i, j, matches(a, b, match), (SKIP_A, SKIP_B, PAIR)):
        i, j = i - (step != SKIP_B), j - (step != SKIP_A)
        out.append((i if step != SKIP_B else None, j if step != SKIP_A else None))
    return out[::-1]


def unit_match(readings: dict[str, str] | None = None) -> Match:
    """Whether a token can stand for a written unit: an ideograph by its reading (from a user's table; without one any
    syllable will do), letters by containment either way, and a syllable for any word of letters."""

    def match(token: str, unit: str) -> bool:
        t, u = token.strip().lower(), unit.lower()
        if "一" <= unit[:1] <= "鿿":
            return readings.get(unit) == t if readings else py_pinyin(t)
        if not u.isascii():
            return False
        bare_t, bare_u = t.strip("<>"), u.strip("<>")
        if t in u or u in t or bare_t in bare_u or bare_u in bare_t:
            return True
        return len(t) >= 2 and t[-1].isdigit() and t[:-1].isalpha()

    return match


def hanzi_labels(words: Sequence[tuple[float, float, str]], text: str, readings: dict[str, str] | None = None) -> list[tuple[float, float, str]]:
    """A hanzi label for every words row: silences graded, punctuation as it is, words by the unit they align with."""
    units = [u for u in word_units(text.replace("<sp1>", "")) if py_word_like(u)]
    sounding = [i for i, (_, _, t) in enumerate(words) if not py_silence(t) and not py_punct(t)]
    label = {}
    for k, r in fuzzy_pairs([words[i][2].strip() for i in sounding], units, unit_match(readings)):
        if k is not None:
            label[sounding[k]] = words[sounding[k]][2].strip() if r is None else units[r]
    out = []
    for i, (x0, x1, t) in enumerate(words):
        out.append((x0, x1, py_grade(x1 - x0) if py_silence(t) else t if py_punct(t) else label.get(i, "")))
    return out


def spellings_normalised(words: Sequence[tuple[float, float, str]], text: str, readings: dict[str, str] | None = None) -> list[tuple[float, float, str]]:
    """Words take the written spelling of the ASCII unit of two letters or more that they align with."""
    out = list(words)
    for i, ((x0, x1, t), (_, _, h)) in enumerate(zip(words, hanzi_labels(words, text, readings), strict=True)):
        if len(h) >= 2 and h.isascii() and h.isalpha() and not py_silence(t) and not py_punct(t):
            out[i] = (x0, x1, h)
    return out


def resliced(phones: Sequence[str], cuts: Sequence[tuple[float, float]], start: float, end: float) -> list[tuple[float, float, str]]:
    """Phones over a word's stretch by aligned slices: as many slices by their own times (10 ms or less are skipped),
    more phones by halving the widest slice, fewer by dropping the right border of the narrowest; without slices evenly."""
    n = len(phones)
    if not n:
        return []
    if not cuts:
        edges = np.linspace(start, end, n + 1)
        return [(float(a), float(b), p) for a, b, p in zip(edges, edges[1:], phones, strict=False)]
    spans = [list(c) for c in cuts]
    if len(spans) == n:
        return [(a, b, p) for (a, b), p in zip(spans, phones, strict=True) if b - a > 0.010]
    while len(spans) < n:
        i = max(range(len(spans)), key=lambda k: spans[k][1] - spans[k][0])
        a, b = spans[i]
        spans[i : i + 1] = [[a, (a + b) / 2], [(a + b) / 2, b]]
    while len(spans) > n:
        i = min(range(len(spans) - 1), key=lambda k: spans[k][1] - spans[k][0])
        spans[i : i + 2] = [[spans[i][0], spans[i + 1][1]]]
    return [(a, b, p) for (a, b), p in zip(spans, phones, strict=True)]


def english_fragments(tokens: Sequence[tuple[str, float, float]], text: str) -> list[tuple[str, float, float]]:
    """Tokens whose stretches are fragments of a written English word become that word over their span.

    Every token of the stretch must be a fragment: a letter or part of the word, or a syllable that shares a letter
    with it; vocalisations never are.
    """
    units = [u for u in word_units(text) if py_word_like(u)]
    pairs = fuzzy_pairs([t for t, _, _ in tokens], units, unit_match())

    def fragment(t: str, u: str) -> bool:
        low, word = t.lower(), u.lower()
        return not py_vocalisation(t) and (low in word or (py_pinyin(low) and bool(set(low[:-1]) & set(word))))

    stretch: dict[int, list[int]] = {}
    last = None
    for i, r in pairs:
        if r is not None and i is not None:
            last = r
        if i is not None and last is not None:
            stretch.setdefault(last, []).append(i)
    out, skip = [], set()
    heads = {}
    for r, members in stretch.items():
        u = units[r]
        if u.isascii() and u.isalpha() and len(u) > 1 and all(fragment(tokens[i][0], u) for i in members):
            heads[members[0]] = (u, tokens[members[0]][1], tokens[members[-1]][2])
            skip.update(members[1:])
    for i, t in enumerate(tokens):
        if i not in skip:
            out.append(heads.get(i, t))
    return out


def positional_match(spoken: Sequence[str], wanted: Sequence[str]) -> list[int | None]:
    """For each wanted word the place of the next equal spoken one, letter case aside; a miss uses up the rest."""
    at, out = 0, []
    for w in wanted:
        found = next((i for i in range(at, len(spoken)) if spoken[i].lower() == w.lower()), None)
        out.append(found)
        at = len(spoken) if found is None else found + 1
    return out


def stressed(phones: Sequence[str], entry: Sequence[str]) -> list[str]:
    """Phones with the stress digits of a lexicon entry they align with; only vowels bear one."""
    bare, known = [p.rstrip("012") for p in phones], [p.rstrip("012") for p in entry]
    out = list(phones)
    for i, j in equal_pairs(bare, known):
        if bare[i] in ENGLISH_VOWELS:
            out[i] = bare[i] + (entry[j][-1] if entry[j][-1] in "012" else "0")
    return out


def pinyin_synced(pinyin: str, text: str) -> str:
    """Pinyin words laid along the characters of a final text, whose punctuation is kept; a character of a word takes
    the next pinyin word, letters one each."""
    words = iter([t for t in pinyin.split() if py_word_like(t)])
    parts = []
    for c in text.replace("<sp1>", ""):
        if py_word_like(c):
            w = next(words, None)
            if w is not None:
                parts.append(w)
        else:
            parts.append(c)
    return "<sp1> " + " ".join(parts)


def equal_pairs_udf(a: Column, b: Column) -> Column:
    """Arrow UDF of ``equal_pairs`` over two arrays of strings: array of (a, b)."""
    @F.pandas_udf("array<struct<a:int,b:int>>")
    def pairs(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([[{"a": i, "b": j} for i, j in equal_pairs(list(p), list(q))] if p is not None and q is not None else None for p, q in zip(x, y, strict=True)])

    return pairs(a, b)
