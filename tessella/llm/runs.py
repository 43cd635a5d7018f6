"""Runs of alike consecutive events, each collapsed into one event with its count and duration.

Adjacent agglomeration: per entity and time shard a linked list of runs and a priority queue of neighbouring pairs;
the most similar pair within the limits is merged until none is left. What could merge across a shard's border is
agglomerated in the same way afterwards, from its events of equal key on, so that shards don't change the result.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Seconds of a time shard.
SHARD_S = 600.0

_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F))) + "　"
_NARROW = "".join(map(chr, range(0x21, 0x7F))) + " "


def alike_key(word: Column) -> Column:
    """The word without regard to letter case, width, brackets and tag marks, blanks, ``_`` and ``-``, and to how
    often a letter is repeated in direct succession. Digits count. Nothing left gives null: such words are alike to none."""
    flat = F.lower(F.translate(word, _WIDE, _NARROW))
    bare = F.regexp_replace(flat, r"[\[\]<>|\s\p{Z}_\-]+", "")
    return F.nullif(F.regexp_replace(bare, r"(\p{L})\1+", "$1"), F.lit(""))


def similarity(a: str | None, b: str | None) -> float:
    """1 for equal keys, else 1 less the edit distance over the longer length; 0 if either is null."""
    if a is None or b is None:
        return 0.0
    if a == b:
        return 1.0
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return 1 - row[-1] / max(len(a), len(b))


@dataclass
class Run:
    """``keys``: the distinct keys of the run's events; ``open_left`` and ``open_right``: whether the next run on that
    side is the direct neighbour."""

    first_id: int
    last_id: int
    start: float
    end: float
    n: int
    keys: tuple[str | None, ...]
    open_left: bool = True
    open_right: bool = True


def linkage(a: Run, b: Run, max_gap: float) -> float:
    """Least similarity between events of two neighbouring runs; 0 where they lie too far apart."""
    if b.start - a.end > max_gap or not (a.open_right and b.open_left):
        return 0.0
    return min(similarity(x, y) for x in a.keys for y in b.keys)


def agglomerate(runs: list[Run], min_similarity: float, max_gap: float, link: Callable[[Run, Run, float], float] = linkage) -> list[Run]:
    """Merge neighbouring runs, most similar first (the earlier pair on ties), until no pair meets the limits."""
    runs = list(runs)
    n = len(runs)
    before, after, version = list(range(-1, n - 1)), [*range(1, n), -1], [0] * n
    queue: list[tuple[float, int, int, int, int]] = []

    def offer(i: int, j: int) -> None:
        s = link(runs[i], runs[j], max_gap)
        if s > 0 and s >= min_similarity:
            heapq.heappush(queue, (-s, i, version[i], j, version[j]))

    for i in range(n - 1):
        offer(i, i + 1)
    alive = [True] * n
    while queue:
        _, i, vi, j, vj = heapq.heappop(queue)
        if not (alive[i] and alive[j]) or version[i] != vi or version[j] != vj or after[i] != j:
            continue
        a, b = runs[i], runs[j]
        runs[i] = Run(a.first_id, b.last_id, a.start, max(a.end, b.end), a.n + b.n, tuple(dict.fromkeys((*a.keys, *b.keys))), a.open_left, b.open_right)
        alive[j], version[i], after[i] = False, version[i] + 1, after[j]
        if after[i] >= 0:
            before[after[i]] = i
            offer(i, after[i])
        if before[i] >= 0:
            offer(before[i], i)
    return [r for r, ok in zip(runs, alive, strict=True) if ok]


_RUN = "dataset string, stem string, shard bigint, seq bigint, first_id bigint, last_id bigint, start_s double, end_s double, n bigint, keys array<string>, open_left boolean, open_right boolean"
_NAMES = [x.split()[0] for x in _RUN.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.string()), pa.bool_(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=_NAMES)


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Columns of each run of rows with equal keys, across batches."""
    held, key = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        names = list(zip(*[cols[k] for k in keys], strict=True))
        cuts = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]], len(names)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = {n: c[a:b] for n, c in cols.items()}
            if held is not None and key == names[a]:
                for n in held:
                    held[n].extend(part[n])
            else:
                if held is not None:
                    yield key, held
                held, key = part, names[a]
    if held is not None:
        yield key, held


def _islands(keys: list[str | None], starts: list[float], ends: list[float], min_similarity: float, max_gap: float) -> Iterator[tuple[int, int]]:
    """Stretches within which neighbours could merge; complete linkage never crosses their borders."""
    a, reach = 0, float("-inf")  # a run ends no later than its stretch so far
    for i in range(1, len(keys) + 1):
        reach = max(reach, ends[i - 1])
        if i < len(keys) and keys[i] is not None and starts[i] - reach <= max_gap and (keys[i] == keys[i - 1] or (min_similarity < 1 and similarity(keys[i - 1], keys[i]) >= min_similarity)):
            continue
        yield a, i
        a, reach = i, float("-inf")


def shard_runs(tokens: DataFrame, min_similarity: float, max_gap_s: float, shard_s: float = SHARD_S) -> DataFrame:
    """Runs of two or more events of each shard; of the stretches at its borders the runs of equal keys, whatever their length."""
    one = (
        tokens.where("token_id is not null and start_s is not null and not isnan(start_s)")
        .select("dataset", "stem", "token_id", F.struct("start_s", F.coalesce("end_s", "start_s").alias("end_s"), "word").alias("v"))
        .withColumn("shard", F.floor(F.col("v.start_s") / shard_s))
        .withColumn("_key", F.xxhash64("dataset", "stem", "shard"))
        .repartition("_key")
        .groupBy("_key", "dataset", "stem", "shard", "token_id")
        .agg(F.min("v").alias("v"))
        .select("_key", "dataset", "stem", "shard", "token_id", F.col("v.start_s").alias("start_s"), F.col("v.end_s").alias("end_s"), alike_key(F.col("v.word")).alias("key"))
        .sortWithinPartitions("_key", "dataset", "stem", "shard", "start_s", "token_id")
    )

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (dataset, stem, shard), c in _grouped(batches, ["dataset", "stem", "shard"]):
            ids, starts, ends, keys = c["token_id"], c["start_s"], c["end_s"], c["key"]
            last = len(ids)
            for a, b in _islands(keys, starts, ends, min_similarity, max_gap_s):
                if b - a == 1 and a > 0 and b < last:
                    continue
                members = [Run(ids[i], ids[i], starts[i], ends[i], 1, (keys[i],)) for i in range(a, b)]
                # equal neighbours merge first whatever the limit; the rest waits where the stretch may go on beyond the shard
                border = a == 0 or b == last
                made = agglomerate(members, 1.0 if border else min_similarity, max_gap_s) if b - a > 1 else members
                for k, r in enumerate(made):
                    if r.n > 1 or border:
                        left, right = border and (k > 0 or a == 0), border and (k < len(made) - 1 or b == last)
                        out.append((dataset, stem, shard, a + k, r.first_id, r.last_id, r.start, r.end, r.n, list(r.keys), left, right))
            if len(out) >= 4096:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return one.mapInArrow(kernel, _RUN)


def event_runs(tokens: DataFrame, min_similarity: float = 1.0, max_gap_s: float = float("inf"), shard_s: float = SHARD_S) -> DataFrame:
    """Maximal runs of two or more alike consecutive events of an utterance.

    ``tokens`` has dataset, stem, token_id, word, start_s and end_s; other columns are ignored. Order is start_s, then
    token_id; a token_id counts once. A missing end counts as the start. Rows without id or start are left out; a null
    word, or one of nothing but marks, is alike to none. Returns (dataset, stem, first_id, last_id, n, start_s, end_s,
    duration_s, key). Similarity below 1 is the edit similarity of ``alike_key`` under complete linkage. The length of a
    time shard, ``shard_s``, does not change the result. Memory is bounded by one time shard of one utterance, and by the
    longest stretch of events each alike to the next that crosses a shard's border; runs of equal keys count there as one.
    """
    border = shard_runs(tokens, min_similarity, max_gap_s, shard_s).withColumn("_key", F.xxhash64("dataset", "stem")).repartition("_key").sortWithinPartitions("_key", "dataset", "stem", "shard", "seq")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def close(dataset: str, stem: str, chain: list[Run]) -> None:
            for r in agglomerate(chain, min_similarity, max_gap_s) if len(chain) > 1 else chain:
                if r.n > 1:
                    out.append((dataset, stem, 0, 0, r.first_id, r.last_id, r.start, r.end, r.n, list(r.keys), True, True))

        held: tuple[tuple, list[Run]] | None = None
        reach = float("-inf")  # latest end of the stretch held
        for batch in batches:
            for row in batch.to_pylist():
                run, at = Run(*(row[k] for k in _NAMES[4:9]), tuple(row["keys"]), row["open_left"], row["open_right"]), (row["dataset"], row["stem"])
                if held and held[0] == at and run.start - reach <= max_gap_s and linkage(held[1][-1], run, float("inf")) >= min_similarity > 0:
                    held[1].append(run)
                    reach = max(reach, run.end)
                else:
                    if held:
                        close(*held[0], held[1])
                    held, reach = (at, [run]), run.end
            if len(out) >= 4096:
                yield _batch(out)
                out.clear()
        if held:
            close(*held[0], held[1])
        if out:
            yield _batch(out)

    runs = border.mapInArrow(kernel, _RUN)
    return runs.select("dataset", "stem", "first_id", "last_id", "n", "start_s", "end_s", (F.col("end_s") - F.col("start_s")).alias("duration_s"), F.col("keys")[0].alias("key"))
