"""Statistics of each document's text, and the kinds they tell apart: prose, list, table, junk.

The statistics are standardized, a Gaussian mixture is fitted to those of all documents by expectation-maximization,
and its components are mapped to kinds by inspected examples.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.session import written

KINDS = ("prose", "list", "tabular", "junk")

# Chinese function words, as the ideographs they are written with (particles, pronouns, prepositions,
# conjunctions, auxiliaries, negations, question words, adverbs of degree, directions), and common English words.
COMMON_IDEOGRAPHS = (
    "的了着过得地吗呢吧啊" "我你您他她它们咱自己" "这那哪此其每各某" "在从到向往对于把被让给跟和与同按由以为比" "而但却或且虽然因所如果若则即使便"
    "是有会能可要想应该须必得愿" "不没未别无非" "什么谁怎几多少何" "很太更最极就才都也又还再已经曾正将刚只总常仍先后" "上下中里外前来去起之等些个"
)
COMMON_WORDS = (
    "a about after against all almost although an and any are as at be because been before behind beneath beside between beyond both but by can do does each every "
    "few for from had has have he her his how i if in inside into is it its just many more most much near no not nothing of off often on once one only or other "
    "our out over rarely said say several she slowly so some soon such than that the their them then there these they thing think this those three through to together "
    "two under unless until up us usually very was we were what when where which while who why will with within without would you your"
).split()

#: Share of a line's words that are common from which the line reads as running sentences, and the length in words
#: from which this is asked of it by itself; shorter lines are judged with their neighbours.
SENTENCE_COMMON = 0.11
#: Documents' statistics, in order.
STATS = ("words", "mean_word", "symbols", "line_ends", "common", "digits", "sentences", "line_length", "odd", "gaps")

_SPACE, _LETTER, _DIGIT, _IDEO, _IDEO_COMMON, _END, _SYMBOL, _ODD, _NEWLINE = range(9)
_ENDS = ".!?。！？…；;:：\"”’'）)"
#: Full-width forms and invisible characters, which the statistics see through.
_DRESSED = re.compile("[\uff01-\uff5e\xad\u200b-\u200f\u2060\ufe0f\ufeff]")
_PLAIN = {**{c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)}, **dict.fromkeys([0xAD, *range(0x200B, 0x2010), 0x2060, 0xFE0F, 0xFEFF], "")}


def _undressed(text: str) -> str:
    text = text.replace("\r", "\n")
    return text.translate(_PLAIN) if _DRESSED.search(text) else text


def _word_code(word: str) -> int:
    """A number for a word of up to eight letters."""
    code = 0
    for c in word:
        code = code * 32 + ord(c) % 32
    return code


_COMMON_CODES = np.array(sorted(map(_word_code, COMMON_WORDS)), np.int64)


def _classes() -> np.ndarray:
    table = np.empty(0x10000, np.uint8)
    for cp in range(0x10000):
        c = chr(cp)
        if c == "\n":
            k = _NEWLINE
        elif c.isspace():
            k = _SPACE
        elif cp == 0xFFFD or 0x80 <= cp < 0xA0 or 0xD800 <= cp < 0xF900 or cp < 0x20:
            k = _ODD
        elif 0x3400 <= cp < 0xA000:
            k = _IDEO
        elif c.isdigit():
            k = _DIGIT
        elif c.isalpha():
            k = _LETTER
        else:
            k = _END if c in _ENDS else _SYMBOL
        table[cp] = k
    for c in COMMON_IDEOGRAPHS:
        table[ord(c)] = _IDEO_COMMON
    return table


_CLASS = _classes()


def text_stats(texts: list[str]) -> np.ndarray:
    """One row of ``STATS`` per text, over whole texts; all lines of the batch are treated at once."""
    n = len(texts)
    if not n:
        return np.zeros((0, len(STATS)))
    texts = [_undressed(t) for t in texts]
    joined = "\n".join(texts) + "\n"
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = np.where(cp < 0x10000, _CLASS[np.minimum(cp, 0xFFFF)], np.uint8(_LETTER))
    ends = np.cumsum([len(t) + 1 for t in texts])
    breaks = np.flatnonzero(kind == _NEWLINE)
    starts = np.concatenate([[0], breaks[:-1] + 1])
    line_doc = np.searchsorted(ends, starts, side="right")

    def per_line(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums[breaks] - sums[starts]

    letter = (kind == _LETTER) | (kind == _DIGIT)
    word_start = letter.copy()
    word_start[1:] &= ~letter[:-1]
    ideo = (kind == _IDEO) | (kind == _IDEO_COMMON)
    solid = (kind != _SPACE) & (kind != _NEWLINE)
    size, ideographs, letters, digits = per_line(solid), per_line(ideo), per_line(kind == _LETTER), per_line(kind == _DIGIT)
    words = per_line(word_start) + ideographs
    symbols, odd = per_line((kind == _SYMBOL) | (kind == _END)), per_line(kind == _ODD)
    common = per_line(kind == _IDEO_COMMON)
    apart = np.zeros(len(kind), bool)
    apart[:-2] = ideo[:-2] & (kind[1:-1] == _SPACE) & ideo[2:]
    gaps = per_line(apart)
    at = np.flatnonzero(word_start)
    if len(at):
        stop = letter.copy()
        stop[:-1] &= ~letter[1:]
        length = np.flatnonzero(stop) - at + 1
        short = length <= 8
        at, length = at[short], length[short]
        code = np.zeros(len(at), np.int64)
        usual = np.ones(len(at), bool)
        for k in range(int(length.max(initial=0))):
            inside = length > k
            c = cp[np.minimum(at + k, len(cp) - 1)].astype(np.int64)
            usual &= ~inside | (((c | 32) >= 97) & ((c | 32) <= 122))
            code = np.where(inside, code * 32 + c % 32, code)
        place = np.minimum(np.searchsorted(_COMMON_CODES, code), len(_COMMON_CODES) - 1)
        np.add.at(common, np.searchsorted(starts, at[usual & (_COMMON_CODES[place] == code)], side="right") - 1, 1)
    # the last solid character of each line
    where = np.maximum.accumulate(np.where(solid, np.arange(len(kind)), -1))
    last = where[np.maximum(breaks - 1, 0)]
    filled = size > 0
    ended = filled & (kind[np.maximum(last, 0)] == _END)

    def per_doc(x: np.ndarray) -> np.ndarray:
        return np.bincount(line_doc, weights=x, minlength=n).astype(float)

    # a line reads as sentences by the common words of itself and the lines beside it, weighted by length
    def spread(x: np.ndarray) -> np.ndarray:
        out = 4.0 * x
        for step in (1, 2):
            same = line_doc[step:] == line_doc[:-step]
            out[step:][same] += x[:-step][same]
            out[:-step][same] += x[step:][same]
        return out

    plain = spread(common) >= SENTENCE_COMMON * np.maximum(spread(words), 1)
    noisy = ((odd + digits * 0.5 + (symbols - ended) * 0.5) > 0.25 * np.maximum(size, 1)) | (gaps > 0.2 * np.maximum(ideographs, 1))
    sentences = np.where(plain & ~noisy, size, 0)
    total, w = np.maximum(per_doc(size), 1), np.maximum(per_doc(words), 1)
    lines = np.maximum(per_doc(filled), 1)
    return np.column_stack([
        per_doc(words),
        (per_doc(letters + digits + ideographs)) / w,
        per_doc(symbols) / total,
        per_doc(ended) / lines,
        per_doc(common) / w,
        per_doc(digits) / total,
        per_doc(sentences) / total,
        total / lines,
        per_doc(odd) / total,
        per_doc(gaps) / np.maximum(per_doc(ideographs), 1),
    ])


_STATS_SCHEMA = "doc_id bigint, " + ", ".join(f"{s} double" for s in STATS)
#: Characters treated at once; a longer text is treated whole by itself.
BATCH_CHARS = 1 << 20


def document_stats(documents: DataFrame) -> DataFrame:
    """(doc_id, *STATS) for every document with a text; an empty text has zeros. Null texts and ids are left out.

    ``words``: ideographs and runs of letters or digits; ``mean_word``: their mean length; ``symbols``, ``digits``,
    ``odd`` (controls, replaced or private characters) and ``sentences`` (lines that read as running sentences): shares
    of the characters that aren't blank; ``line_ends``: share of lines that end in punctuation; ``common``: share of
    common words; ``line_length``: mean characters of a line; ``gaps``: share of ideographs parted from the next by a blank.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held, size, a = batch.column("doc_id"), [], 0, 0
            column = batch.column("text")
            for i in range(batch.num_rows):
                held.append(column[i].as_py())
                size += len(held[-1])
                if size >= BATCH_CHARS or i == batch.num_rows - 1:
                    x = text_stats(held)
                    yield pa.RecordBatch.from_arrays([ids.slice(a, i + 1 - a), *[pa.array(c) for c in x.T]], names=["doc_id", *STATS])
                    held, size, a = [], 0, i + 1

    return documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(kernel, _STATS_SCHEMA)


def features(x: np.ndarray) -> np.ndarray:
    """Statistics on scales on which kinds are roughly normal: lengths by logarithm, shares stretched at their ends."""
    y = x.astype(float).copy()
    for i in (STATS.index("words"), STATS.index("mean_word"), STATS.index("line_length")):
        y[:, i] = np.log1p(y[:, i])
    for s in ("symbols", "digits", "odd"):
        y[:, STATS.index(s)] = np.sqrt(y[:, STATS.index(s)])
    return y


@dataclass(frozen=True)
class Mixture:
    """Standardization, and weight, mean and covariance of each component with its kind."""

    center: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    mean: np.ndarray
    cov: np.ndarray
    kinds: tuple[str, ...] = ()

    def standardized(self, x: np.ndarray) -> np.ndarray:
        return (features(x) - self.center) / self.scale

    def posterior(self, z: np.ndarray) -> np.ndarray:
        logs = np.empty((len(z), len(self.weight)))
        for k in range(len(self.weight)):
            chol = np.linalg.cholesky(self.cov[k])
            u = np.linalg.solve(chol, (z - self.mean[k]).T)
            logs[:, k] = np.log(self.weight[k]) - 0.5 * (u * u).sum(0) - np.log(np.diag(chol)).sum()
        logs -= logs.max(1, keepdims=True)
        p = np.exp(logs)
        return p / p.sum(1, keepdims=True)


# Statistics of inspected texts of each kind, which map components that no rated document falls into
# and start the fit where there are no ratings. Order as in STATS.
INSPECTED = (
    ("prose", (150, 1.05, 0.09, 0.95, 0.27, 0.00, 1.00, 150, 0.0, 0)),
    ("prose", (120, 5.30, 0.02, 0.95, 0.40, 0.00, 1.00, 300, 0.0, 0)),
    ("prose", (130, 1.05, 0.10, 0.95, 0.25, 0.01, 1.00, 28, 0.0, 0)),
    ("prose", (150, 5.30, 0.02, 0.10, 0.40, 0.00, 1.00, 90, 0.0, 0)),
    ("list", (120, 1.00, 0.01, 0.02, 0.05, 0.00, 0.02, 5, 0.0, 0.25)),
    ("list", (60, 6.00, 0.05, 0.30, 0.01, 0.02, 0.00, 20, 0.0, 0)),
    ("list", (80, 1.00, 0.30, 0.50, 0.05, 0.00, 0.00, 200, 0.0, 0.0)),
    ("tabular", (150, 2.70, 0.22, 0.00, 0.00, 0.60, 0.00, 22, 0.0, 0)),
    ("tabular", (90, 4.00, 0.25, 0.05, 0.00, 0.30, 0.00, 45, 0.0, 0)),
    ("junk", (10, 40.0, 0.03, 0.00, 0.00, 0.16, 0.00, 65, 0.0, 0)),
    ("junk", (3, 1.00, 0.99, 0.05, 0.00, 0.01, 0.00, 40, 0.0, 0)),
    ("junk", (80, 1.05, 0.02, 0.00, 0.03, 0.00, 0.00, 300, 0.0, 0.5)),
    ("junk", (80, 1.05, 0.05, 0.60, 0.20, 0.00, 0.00, 150, 0.5, 0)),
)

#: Ratings that the nearest inspected text weighs as, so that a mistaken rating or two don't name a small component.
INSPECTED_VOTES = 3.0
#: Rated documents inspected at most, the first by hash of their id.
RATED_ROWS = 5000


def _moments(stats: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of the features over all documents."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = features(np.column_stack([b.column(s).to_numpy() for s in STATS]))
            flat = np.concatenate([[len(y)], y.sum(0), (y * y).sum(0)])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["i", "v"])

    rows = stats.mapInArrow(kernel, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    flat, d = {r.i: r.v for r in rows}, len(STATS)
    if not flat or not flat[0]:
        return np.zeros(d), np.ones(d)
    mean = np.array([flat[1 + i] for i in range(d)]) / flat[0]
    square = np.array([flat[1 + d + i] for i in range(d)]) / flat[0]
    return mean, np.sqrt(np.maximum(square - mean**2, 1e-4))


def _step(stats: DataFrame, model: Mixture, floor: float) -> tuple[Mixture, float]:
    """One round of expectation and maximization over all documents; also the largest change of a weight.

    Each batch sends only the sums of its components, which Spark adds up; nothing grows with the documents.
    """
    k, d = model.mean.shape

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, 1 + d + d * d))
        for b in batches:
            if b.num_rows:
                z = model.standardized(np.column_stack([b.column(s).to_numpy() for s in STATS]))
                p = model.posterior(z)
                total[:, 0] += p.sum(0)
                total[:, 1 : 1 + d] += p.T @ z
                total[:, 1 + d :] += np.einsum("nk,ni,nj->kij", p, z, z, optimize=True).reshape(k, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["i", "v"])

    rows = stats.mapInArrow(kernel, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    sums = np.zeros(k * (1 + d + d * d))
    for r in rows:
        sums[r.i] = r.v
    sums = sums.reshape(k, -1)
    n = sums[:, 0]
    mean, cov = model.mean.copy(), model.cov.copy()
    for c in range(k):
        if n[c] > d:  # a component that holds next to nothing stays as it is
            mean[c] = sums[c, 1 : 1 + d] / n[c]
            cov[c] = (sums[c, 1 + d :] / n[c]).reshape(d, d) - np.outer(mean[c], mean[c]) + floor * np.eye(d)
            cov[c] = (cov[c] + cov[c].T) / 2
    weight = np.maximum(n, 1e-3 * max(1.0, n.sum()) / k)
    weight /= weight.sum()
    return Mixture(model.center, model.scale, weight, mean, cov), float(np.abs(weight - model.weight).max())


def _third_nearest(points: np.ndarray, rows: int = 128) -> np.ndarray:
    """Distance of each point to the third nearest, itself included; a block of rows at a time."""
    k, square = min(2, len(points) - 1), (points * points).sum(1)
    out = np.empty(len(points))
    for a in range(0, len(points), rows):
        d = square[a : a + rows, None] + square[None] - 2 * points[a : a + rows] @ points.T
        out[a : a + rows] = np.sqrt(np.maximum(np.partition(d, k, axis=1)[:, k], 0))
    return out


def fit_mixture(stats: DataFrame, rated: DataFrame, rounds: int = 12, tolerance: float = 1e-3, floor: float = 0.02, per_kind: int = 5, rated_rows: int = RATED_ROWS) -> Mixture:
    """A mixture fitted to the statistics of all documents, its components mapped to kinds.

    ``rated`` has doc_id and kind; at most ``rated_rows`` rated documents are inspected. They start the components,
    ``per_kind`` of each kind spread over its examples, beside the module's own inspected texts. After ``rounds`` of
    expectation-maximization, or once no weight changes by more than ``tolerance``, a component takes the kind of most
    ratings that fall into it, the nearest inspected text counting as ``INSPECTED_VOTES`` of them.
    """
    center, scale = _moments(stats)
    names = rated.where(F.col("kind").isin(*KINDS)).select(F.col("doc_id").cast("bigint").alias("doc_id"), "kind").distinct()
    # thin the ratings by hash before they are sorted, so that no more than about twice the bound is gathered
    share = min(1.0, 2 * rated_rows / max(1, names.count()))
    few = names.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = stats.join(few, "doc_id").orderBy(F.xxhash64("doc_id", "kind")).limit(rated_rows).collect()
    shape = Mixture(center, scale, np.ones(1), np.zeros((1, len(STATS))), np.eye(len(STATS))[None])
    seen = shape.standardized(np.array([[r[s] for s in STATS] for r in rows]).reshape(-1, len(STATS)))
    said = np.array([r.kind for r in rows], dtype=object)
    known = shape.standardized(np.array([x for _, x in INSPECTED], float))
    known_kind = np.array([k for k, _ in INSPECTED], dtype=object)
    means = []
    for kind in KINDS:
        # farthest points first, from the median of the kind's examples on; lone mistakes of raters are left out
        mine = seen[said == kind]
        if len(mine) >= 3:
            near = _third_nearest(mine)
            mine = mine[near <= np.quantile(near, 0.9)]
        mine = np.vstack([np.median(mine, 0, keepdims=True), mine, known[known_kind == kind]]) if len(mine) else known[known_kind == kind]
        chosen = [0]
        away = ((mine - mine[0]) ** 2).sum(1)
        while len(chosen) < min(per_kind, len(mine)):
            chosen.append(int(away.argmax()))
            away = np.minimum(away, ((mine - mine[chosen[-1]]) ** 2).sum(1))
        means += [mine[i] for i in chosen]
    k, d = len(means), len(STATS)
    model = Mixture(center, scale, np.full(k, 1 / k), np.array(means), np.repeat(np.eye(d)[None] * 0.3, k, 0))
    for _ in range(rounds):
        model, change = _step(stats, model, floor)
        if change < tolerance:
            break
    votes = np.zeros((k, len(KINDS)))
    if len(seen):
        p = model.posterior(seen)
        for j, kind in enumerate(KINDS):
            votes[:, j] = p[said == kind].sum(0)
    for c in range(k):
        votes[c, KINDS.index(known_kind[((known - model.mean[c]) ** 2).sum(1).argmin()])] += INSPECTED_VOTES
    kinds = [KINDS[j] for j in votes.argmax(1)]
    return Mixture(center, scale, model.weight, model.mean, model.cov, tuple(kinds))


def classified(stats: DataFrame, model: Mixture) -> DataFrame:
    """``stats`` with ``kind`` and the probability ``p_prose`` of prose."""
    index = np.array([KINDS.index(k) for k in model.kinds])
    schema = _STATS_SCHEMA + ", kind string, p_prose double"

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            p = model.posterior(model.standardized(np.column_stack([b.column(s).to_numpy() for s in STATS])))
            by = np.zeros((b.num_rows, len(KINDS)))
            for c, j in enumerate(index):
                by[:, j] += p[:, c]
            kind = pa.array([KINDS[j] for j in by.argmax(1)])
            yield pa.RecordBatch.from_arrays([*b.columns, kind, pa.array(by[:, 0])], names=[*b.schema.names, "kind", "p_prose"])

    return stats.mapInArrow(kernel, schema)


def document_kinds(documents: DataFrame, rated: DataFrame) -> DataFrame:
    """Statistics, kind and probability of prose of every document with a text; see ``document_stats``.

    The statistics are written once to the shared folder, since every round of the fit reads them. A document
    delivered twice counts once. An empty table gives no rows.
    """
    stats = written(document_stats(documents.select("doc_id", "text")).dropDuplicates(["doc_id"]), "stats")
    return classified(stats, fit_mixture(stats, rated))


def not_prose(kinds: DataFrame) -> DataFrame:
    """Documents of another kind than prose."""
    return kinds.where(F.col("kind") != "prose")
