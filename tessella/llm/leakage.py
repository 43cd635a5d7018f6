"""Documents that hold passages of held-out evaluation texts.

One Aho-Corasick automaton over fragments of all normalised test texts scans each document's text once. Matches are
joined to exact stretches, these are chained along the diagonals of (item, document) positions, so that scattered
changes within a passage are bridged, and the chained passages' share of the item's wording decides. Positions map
back to the original text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.lookalike import fold_char

#: Tokens of the test items that one automaton holds, which bounds its memory; items beyond go into a further one.
BLOCK_TOKENS = 500_000
#: Characters scanned at once; a longer text is scanned whole by itself.
BATCH_CHARS = 1 << 19

_TAG = re.compile(r"<[^<>\n\0]{1,40}>|\[[^\[\]\n\0]{1,40}\]")
_OPENS = (ord("<"), ord("["))

# What is compared of a character, by code point and filled as characters turn up: nothing, a blank, one letter, or several.
_NEW, _SEVERAL = 0xFFFFFFFF, 0xFFFFFFFE
_BLANK, _END = 32, 1  # ``_END`` stands between the texts of a batch
_ONE = np.full(0x110000, _NEW, np.uint32)
_ONE[0] = _END
_PARTS: dict[int, list[int]] = {}


def _learn(points: np.ndarray) -> None:
    for cp in points.tolist():
        parts = fold_char(chr(cp)).lower()
        kept = [ord(x) for x in parts if x.isalnum()]
        if len(kept) > 1:
            _PARTS[cp] = kept
            _ONE[cp] = _SEVERAL
        elif kept:
            _ONE[cp] = kept[0]
        else:
            marks = not parts or (not chr(cp).isspace() and all("̀" <= x <= "ͯ" for x in parts))
            _ONE[cp] = 0 if marks else _BLANK


#: Multiplier of the words' 64-bit names and its powers, as far as words were long.
_MULTIPLIER = 0x9E3779B97F4A7C15
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.concatenate([[1], np.cumprod(np.full(2 * n, _MULTIPLIER, np.uint64))]).astype(np.uint64)
    return _POWERS


CJK_W, WORD_W = 4, 7


@dataclass
class Tokens:
    """Tokens of a batch of texts: ``name`` is the ideograph, or a 64-bit name of the word with its top bit set; ``at``
    the token's first character in the batch, ``doc`` its text. A token named ``_END`` closes each text but the last."""

    name: np.ndarray
    at: np.ndarray
    doc: np.ndarray

    @property
    def weight(self) -> np.ndarray:
        return np.where(self.name >> np.uint64(63), WORD_W, CJK_W).astype(np.int64)


def tokens(texts: list[str]) -> Tokens:
    """Ideographs and words of texts, folded; tags in angle or square brackets are left out. All texts at once."""
    joined = "\0".join(t.replace("\0", " ") if "\0" in t else t for t in texts)
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    opens = np.flatnonzero((cp == _OPENS[0]) | (cp == _OPENS[1]))
    if len(opens):
        cp = cp.copy()
        past = 0
        for i in opens.tolist():
            if i >= past and (m := _TAG.match(joined, i)):
                past = m.end()
                cp[i:past] = _BLANK
    x = _ONE[cp]
    if (new := x == _NEW).any():
        _learn(np.unique(cp[new]))
        x = _ONE[cp]
    where = np.arange(len(x))
    if (many := x == _SEVERAL).any():
        counts = np.ones(len(x), np.int64)
        lists = [_PARTS[c] for c in cp[many].tolist()]
        counts[many] = [len(p) for p in lists]
        several = np.repeat(many, counts)
        x, where = np.repeat(x, counts), np.repeat(where, counts)
        x[several] = np.concatenate(lists)
    kept = x != 0
    x, where = x[kept], where[kept]
    word = ((x >= 97) & (x <= 122)) | ((x >= 48) & (x <= 57))
    start = x != _BLANK
    start[1:] &= ~(word[1:] & word[:-1])
    at = np.flatnonzero(start)
    name = x[at].astype(np.uint64)
    letters = np.flatnonzero(word)
    if len(letters):
        begins = np.flatnonzero(start[letters])
        length = np.diff(np.append(begins, len(letters)))
        place = np.arange(len(letters)) - np.repeat(begins, length)
        sums = np.add.reduceat((x[letters].astype(np.uint64) + np.uint64(1)) * _powers(int(length.max()))[place], begins)
        name[word[at]] = (sums ^ (sums >> np.uint64(29))) | np.uint64(1 << 63)
    ends = name == _END
    return Tokens(name, where[at], np.cumsum(ends) - ends)


@dataclass(frozen=True)
class Matching:
    """Weights of a token are ``CJK_W`` for an ideograph and ``WORD_W`` for a word. ``seed`` is the weight of a
    fragment, ``firm`` that of an unchanged stretch that makes a passage by itself trustworthy, ``gap`` the tokens
    bridged between two stretches of a passage, ``drift`` how far these may shift against each other, ``passage`` the
    least weight of a passage, ``density`` the least matched share of it; a passage without a firm stretch needs
    ``loose`` matched weight and ``loose_density``. ``share`` is the share of the item's wording that makes a case."""

    seed: int = 20
    firm: int = 24
    gap: int = 12
    drift: int = 5
    passage: int = 48
    density: float = 0.5
    loose: int = 96
    loose_density: float = 0.65
    share: float = 0.5


Passage = tuple[int, int, int, int]
Found = tuple[int, int, float, list[Passage]]


class Scanner:
    """Fragments of the items in one automaton, and the matching of documents against all items.

    The automaton's symbols are digits of a token's number to the base ``BASE``, each place with digits of its own: any
    number of different tokens fits, no node has more than ``BASE`` followers, and no match starts within a token.
    """

    BASE = 128

    def __init__(self, items: list[tuple[int, str]], matching: Matching = Matching()):
        self.m = matching
        self.ids = [i for i, _ in items]
        self.names, self.places = np.zeros(0, np.uint64), 1
        own = tokens([t for _, t in items]) if items else Tokens(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        real = own.name != _END
        self.names = np.unique(own.name[real])
        while self.BASE**self.places <= len(self.names):
            self.places += 1
        self.rank_of = np.zeros(0x110000, np.uint32)
        chars = self.names < np.uint64(0x110000)
        self.rank_of[self.names[chars].astype(np.int64)] = np.flatnonzero(chars) + 1
        weight, doc = own.weight[real], own.doc[real]
        counts = np.bincount(doc, minlength=len(items)) if items else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.sums = np.concatenate([[0], np.cumsum(weight)]).astype(np.int64)
        self.total = self.sums[self.first[1:]] - self.sums[self.first[:-1]]
        self._build(self.symbols(own.name[real]))

    def ranks(self, names: np.ndarray) -> np.ndarray:
        """Numbers of tokens from 1 on; 0 for those that no item has."""
        out = np.zeros(len(names), np.int64)
        words = (names >> np.uint64(63)).astype(bool)
        out[~words] = self.rank_of[names[~words].astype(np.int64)]
        if len(self.names) and words.any():
            asked = names[words]
            near = np.minimum(np.searchsorted(self.names, asked), len(self.names) - 1)
            out[words] = np.where(self.names[near] == asked, near + 1, 0)
        return out

    def symbols(self, names: np.ndarray) -> str:
        rest, out = self.ranks(names), np.empty((len(names), self.places), np.uint32)
        for k in range(self.places):
            out[:, k] = 0x100 + k * self.BASE + rest % self.BASE
            rest = rest // self.BASE
        return out.tobytes().decode("utf-32-le")

    def _build(self, text: str) -> None:
        """Every shortest stretch of the seed's weight; an item shorter than that is its own fragment."""
        places: dict[str, list[int]] = {}
        item = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        stops = np.searchsorted(self.sums, self.sums[:-1] + self.m.seed)
        last = self.first[1:][item]
        short = self.total[item] < self.m.seed
        begins = np.arange(len(item)) == self.first[:-1][item]
        take = np.where(short, begins, stops <= last)
        d = self.places
        for a, b in zip(np.flatnonzero(take).tolist(), np.where(short, last, stops)[take].tolist(), strict=True):
            places.setdefault(text[a * d : b * d], []).append(a)
        self.automaton = ahocorasick.Automaton()
        starts, at = [0], []
        for n, (fragment, where) in enumerate(places.items()):
            self.automaton.add_word(fragment, n)
            at += where
            starts.append(len(at))
        self.empty = not places
        if not self.empty:
            self.automaton.make_automaton()
        self.starts, self.at, self.item_of = np.array(starts, np.int64), np.array(at, np.int64), item
        self.span = np.where(short, last, stops) - np.arange(len(item))

    def stretches(self, t: Tokens) -> tuple[np.ndarray, ...]:
        """Maximal unchanged stretches of fragments: (text, item, from and to among all items' tokens, from among the
        batch's tokens), ordered by text, item and place in the text."""
        hits = np.fromiter(chain.from_iterable(self.automaton.iter(self.symbols(t.name))), np.int64).reshape(-1, 2)
        end, fragment = hits[:, 0] // self.places, hits[:, 1]
        count = self.starts[fragment + 1] - self.starts[fragment]
        nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        ip = self.at[np.repeat(self.starts[fragment], count) + nth]
        dp = np.repeat(end + 1, count) - self.span[ip]
        # place in the text behind the diagonal, in one number each, so that sorting needs nothing else
        bits, shift = int(len(t.name)).bit_length(), len(self.item_of)
        key = np.sort(((dp - ip + shift) << bits) | dp)
        dp = key & ((1 << bits) - 1)
        diagonal = key >> bits
        ip = dp + shift - diagonal
        to, item = ip + self.span[ip], self.item_of[ip]
        new = np.ones(len(ip), bool)
        new[1:] = (diagonal[1:] != diagonal[:-1]) | (item[1:] != item[:-1]) | (ip[1:] > to[:-1])
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(ip)) - 1 if len(a) else a
        ip, to, dp, item = ip[a], to[b], dp[a], item[a]
        doc = t.doc[dp]
        order = np.argsort(((doc * len(self.ids) + item) << bits) | dp, kind="stable")
        return doc[order], item[order], ip[order], to[order], dp[order]

    def find_all(self, texts: list[str]) -> list[Found]:
        """(text's number, item id, share of its wording, passages) for each item a text gives away; passages are (item
        from, item to, character from, character to)."""
        if self.empty or not texts:
            return []
        t = tokens(texts)
        doc, item, ip, to, dp = self.stretches(t)
        if not len(doc):
            return []
        cuts = np.concatenate([[0], np.flatnonzero((doc[1:] != doc[:-1]) | (item[1:] != item[:-1])) + 1, [len(doc)]])
        chained = self._chained(doc, item, ip, to, dp)
        held = np.add.reduceat(chained, cuts[:-1])
        likely = np.flatnonzero(held >= self.total[item[cuts[:-1]]] * self.m.share * self.m.density)
        bounds = np.concatenate([[0], np.cumsum([len(x) + 1 for x in texts])])
        out: list[Found] = []
        for g in likely.tolist():
            a, b = int(cuts[g]), int(cuts[g + 1])
            k = int(item[a])
            base = int(self.first[k])
            some = a + np.flatnonzero(chained[a:b])
            weights = np.diff(self.sums[base : self.first[k + 1] + 1])
            if not self._dense(weights, ip[some] - base, to[some] - base) >= self.total[k] * self.m.share:
                continue
            passages = self._passages(k, ip[some].tolist(), to[some].tolist(), dp[some].tolist())
            covered = np.zeros(len(weights), bool)
            for i0, i1, _, _ in passages:
                covered[i0 - base : i1 - base] = True
            share = float(weights[covered].sum()) / float(self.total[k])
            if share >= self.m.share:
                n = int(doc[a])
                stop = lambda d, n=n: int(t.at[d] if d < len(t.at) and t.doc[d] == n and t.name[d] != _END else bounds[n + 1] - 1) - int(bounds[n])
                out.append((n, self.ids[k], share, [(i0 - base, i1 - base, int(t.at[d0]) - int(bounds[n]), stop(d1)) for i0, i1, d0, d1 in passages]))
        return out

    def _chained(self, doc: np.ndarray, item: np.ndarray, ip: np.ndarray, to: np.ndarray, dp: np.ndarray, back: int = 4) -> np.ndarray:
        """Weights of the stretches that are a passage by themselves or lie near enough to another to form one; 0 for the
        rest, of which no passage can be made. Each is compared with ``back`` before it; where more lie near, it counts."""
        m, weight, end = self.m, self.sums[to] - self.sums[ip], dp + to - ip
        least = np.minimum(m.passage, self.total[item] * m.share)
        ok = weight >= least
        group = np.zeros(len(doc), np.int64)
        group[1:] = np.cumsum((doc[1:] != doc[:-1]) | (item[1:] != item[:-1]))
        reach = np.maximum.accumulate(end + (group << 36)) - (group << 36)  # no stretch of the group before ends later
        for k in range(1, back + 1):
            near = (group[k:] == group[:-k]) & (dp[k:] - reach[:-k] <= m.gap)
            if k < back:
                near &= np.abs((dp - ip)[k:] - (dp - ip)[:-k]) <= 2 * m.drift
            ok[k:] |= near
            ok[:-k] |= near
        # what is left falls into clusters along the text, each with room for a passage or not
        some = np.flatnonzero(ok)
        if len(some):
            g, w, whole = group[some], weight[some], self.total[item[some]]
            reach = np.maximum.accumulate(end[some] + (g << 36)) - (g << 36)
            first = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (dp[some][1:] - reach[:-1] > m.gap)))
            good = (np.maximum.reduceat(w, first) >= np.minimum(m.firm, whole[first])) | (np.add.reduceat(w, first) >= np.minimum(m.loose, 0.75 * whole[first]))
            ok[some] = np.repeat(good, np.diff(np.append(first, len(some))))
        return np.where(ok, weight, 0)

    def _dense(self, weights: np.ndarray, ip: np.ndarray, to: np.ndarray) -> int:
        """Weight of the item's tokens that lie in any span of which the stretches, wherever they are in the text, hold
        ``density``: no passages hold more."""
        n = len(weights)
        depth = np.bincount(ip, minlength=n + 1) - np.bincount(to, minlength=n + 1)
        surplus = np.concatenate([[0.0], np.cumsum(np.where(np.cumsum(depth)[:n] > 0, 1 - self.m.density, -self.m.density) * weights)])
        best = np.maximum.accumulate(surplus[::-1])[::-1][1:] - np.minimum.accumulate(surplus)[:-1]
        return int(weights[best >= -1e-9].sum())

    def find(self, text: str) -> list[tuple[int, float, list[Passage]]]:
        return [x[1:] for x in self.find_all([text])] if text else []

    def _passages(self, k: int, ip: list[int], to: list[int], dp: list[int]) -> list[Passage]:
        """Chains of stretches in document order whose shifts stay close; each as what it spans."""
        m, sums = self.m, self.sums
        open_: list[list[int]] = []  # item from, item to, token from, token to, matched weight, weight of the longest stretch
        done: list[list[int]] = []
        for i, j, d in zip(ip, to, dp, strict=True):
            e, best, still = d + j - i, None, []
            for c in open_:
                if d - c[3] > m.gap:
                    done.append(c)
                    continue
                still.append(c)
                shift = abs((i - d) - (c[1] - c[3]))
                if shift <= m.drift and i >= c[0] and i - c[1] <= m.gap and j > c[1] and (best is None or shift < best[0]):
                    best = (shift, c)
            open_ = still
            w = int(sums[j] - sums[i])
            if best:
                c = best[1]
                c[4] += int(sums[j] - sums[max(i, c[1])])
                c[1], c[3], c[5] = j, max(c[3], e), max(c[5], w)
            else:
                open_.append([i, j, d, e, w, w])
        whole = int(self.total[k])
        out = []
        for c in [*done, *open_]:
            span = int(sums[c[1]] - sums[c[0]])
            firm = c[5] >= min(m.firm, whole) and c[4] >= m.density * span
            loose = c[4] >= min(m.loose, 0.75 * whole) and c[4] >= m.loose_density * span
            if span >= min(m.passage, whole * m.share) and (firm or loose):
                out.append((c[0], c[1], c[2], c[3]))
        return out


_SCHEMA = "doc_id bigint, item_id bigint, share double, passages array<struct<item_from:int,item_to:int,char_from:int,char_to:int>>"
_SCANNERS: dict[str, Scanner] = {}


def _scanner(name: str, items: list[tuple[int, str]], matching: Matching) -> Scanner:
    """The automaton of these items, built once in a worker process and kept for its later tasks."""
    if name not in _SCANNERS:
        while len(_SCANNERS) >= 2:
            del _SCANNERS[next(iter(_SCANNERS))]
        _SCANNERS[name] = Scanner(items, matching)
    return _SCANNERS[name]


def leaks(documents: DataFrame, items: DataFrame, matching: Matching = Matching(), block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, item_id, share, passages) for every document that holds at least ``matching.share`` of an item's wording.

    Case, punctuation, width, look-alike letters, blanks, line breaks and tags in between do not matter, and changes of
    single words or characters are bridged. ``passages`` gives token positions in the item and character offsets in
    the original document text. The test items are a stated set: all of them form one automaton, in which any number of
    different words has room, unless they hold more than ``block_tokens`` tokens, which bounds the memory of a worker and
    what is sent to it; further items then form further automata over the same documents. Each item is judged by
    itself, so that the blocks do not change the result. Every document is scanned whole. Null texts and ids give
    nothing; a document or item delivered twice counts once. No item or document gives no rows. Extra columns are ignored.
    """
    spark: SparkSession = documents.sparkSession
    held = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("bigint"), "text").groupBy("item_id").agg(F.min("text").alias("text")).orderBy("item_id")
    rows = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def scan(block: list[tuple[int, str]]) -> DataFrame:
        shared, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kind = pa.list_(pa.struct([(n, pa.int32()) for n in ("item_from", "item_to", "char_from", "char_to")]))
            scanner = None
            for batch in batches:
                scanner = scanner or _scanner(name, shared.value, matching)
                ids, column, made = batch.column("doc_id"), batch.column("text"), []
                texts, size, a = [], 0, 0
                for i in range(batch.num_rows):
                    texts.append(column[i].as_py())
                    size += len(texts[-1])
                    if size >= BATCH_CHARS or i == batch.num_rows - 1:
                        made += [(ids[a + n].as_py(), item, share, [dict(zip(("item_from", "item_to", "char_from", "char_to"), p, strict=True)) for p in ps]) for n, item, share, ps in scanner.find_all(texts)]
                        texts, size, a = [], 0, i + 1
                cols = list(zip(*made, strict=True)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), kind), strict=True)], names=["doc_id", "item_id", "share", "passages"])

        return rows.mapInArrow(kernel, _SCHEMA)

    out, block, size = None, [], 0
    for row in held.toLocalIterator():
        n = len(tokens([row.text]).name)
        if block and size + n > block_tokens:
            out = scan(block) if out is None else out.unionByName(scan(block))
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += n
    if block or out is None:
        out = scan(block) if out is None else out.unionByName(scan(block))
    return out.dropDuplicates(["doc_id", "item_id"])
