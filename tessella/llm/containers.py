"""Filling containers of fixed capacity with documents measured in tokens.

Linear grouping scheme over one histogram of lengths for the whole collection: large lengths are rounded up within
groups of equal cardinality, configurations of the few sizes left are optimised by linear programming with generated
columns, actual documents take the places of the rounded ones, and small documents go by best fit into the room that
remains. The plan is made of counts, so its size depends on the capacity, not on the documents; each document finds its
container by its length and its rank among the documents of that length.
"""

from __future__ import annotations

import base64
import hashlib
import os
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.session import written

#: Documents of one length that are ranked in one task; more are ranked in parts by a hash of their id.
RANKED_DOCS = 500_000
#: Sizes that large lengths are rounded up to.
GROUPS = 24
#: Shares of the capacity above which lengths count as large, tried in turn: the more documents count as small, the
#: better they fill what rounding leaves; the fewer, the more the configurations decide.
LARGE = (0.25, 0.33, 0.5, 0.05)
#: A packing within this share of the least number of containers possible ends the trials.
CLOSE = 0.0005
#: Bytes of a vocabulary file that are sent to the tasks; a larger one is read by each worker from its path.
SENT_VOCABULARY = 64 << 20


def tokenizer_path(name: str = "byte_bpe_multi_50k.tiktoken", folder: str | None = None) -> str:
    """The vocabulary file of a public tokenizer."""
    return os.path.join(folder or os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), name)


_COUNTERS: dict[str, Callable[[list[str]], list[int]]] = {}


def counter_of(name: str, data: bytes) -> Callable[[list[str]], list[int]]:
    """A function giving the numbers of tokens of texts, from a vocabulary file's name, for its kind, and content."""
    key = f"{name} {hashlib.sha256(data).hexdigest()}"
    if key not in _COUNTERS:
        _COUNTERS[key] = _loaded(name, data)
    return _COUNTERS[key]


def _loaded(name: str, data: bytes) -> Callable[[list[str]], list[int]]:
    if name.endswith(".tiktoken"):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        # Fixed value: the public splitting pattern of these vocabularies.
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        encoding = tiktoken.Encoding(os.path.basename(name), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(encoding.encode_ordinary(t)) for t in texts]
    if name.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=data)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    model = Tokenizer.from_buffer(data)
    model.encode_special_tokens = True
    return lambda texts: [len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)]


def _content(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def token_counter(path: str) -> Callable[[list[str]], list[int]]:
    return counter_of(path, _content(path))


def token_lengths(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of every document, once; a null text has no tokens. Rows without id are left out.

    The vocabulary is read where the plan is made and sent to the tasks, up to ``SENT_VOCABULARY`` bytes.
    """
    path = path or tokenizer_path()
    rows = documents.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sent = documents.sparkSession.sparkContext.broadcast(_content(path)) if os.path.exists(path) and os.path.getsize(path) <= SENT_VOCABULARY else None

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter_of(path, sent.value) if sent is not None else token_counter(path)
        for b in batches:
            n = count([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    return rows.mapInArrow(kernel, "doc_id bigint, n_tokens bigint").groupBy("doc_id").agg(F.max("n_tokens").alias("n_tokens"))


def _best_configuration(sizes: np.ndarray, value: np.ndarray, capacity: int, most: np.ndarray) -> np.ndarray:
    """The configuration of greatest value: an unbounded knapsack over the sizes, by dynamic programming.

    Value only depends on the room, so the table has one entry per unit of room; ``most`` bounds the counts.
    """
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    useful = [k for k in np.argsort(-value / sizes) if value[k] > 1e-12 and most[k] > 0]
    lists = [(k, int(sizes[k]), float(value[k])) for k in useful]
    for room in range(1, capacity + 1):
        top, by = best[room - 1], -1
        for k, s, v in lists:
            if s <= room and best[room - s] + v > top + 1e-12:
                top, by = best[room - s] + v, k
        best[room], taken[room] = top, by
    out, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        k = taken[room]
        if k < 0:
            room -= 1
        else:
            out[k] += 1
            room -= int(sizes[k])
    return out


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 60) -> list[tuple[np.ndarray, int]]:
    """Configurations of few sizes and how often each is used, together at least ``demand`` less a rest.

    The linear program "fewest containers" is solved by the revised simplex method; each round prices all
    configurations by one knapsack and takes in the best. Uses are rounded down: the rest is fitted singly.
    """
    n = len(sizes)
    basis = np.diag(np.maximum(1, capacity // sizes)).astype(float)
    for _ in range(rounds):
        dual = np.linalg.solve(basis.T, np.ones(n))
        column = _best_configuration(sizes, np.maximum(dual, 0), capacity, demand).astype(float)
        if dual @ column <= 1 + 1e-6:
            break
        x, step = np.linalg.solve(basis, demand.astype(float)), np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column
    uses = np.floor(np.maximum(np.linalg.solve(basis, demand.astype(float)), 0) + 1e-9).astype(np.int64)
    return [(basis[:, k].astype(np.int64), int(u)) for k, u in enumerate(uses) if u]


class Plan:
    """Containers for the documents of a histogram: each run of ranks of a length goes to successive containers.

    Documents are thought in one order, longest first; ``takes`` has (from, to, container, per): the documents at these
    places go ``per`` to a container. ``rooms`` has the containers with room left, as runs of numbers by their room.
    """

    def __init__(self, lengths: np.ndarray, counts: np.ndarray, capacity: int):
        order = np.argsort(-lengths)
        self.lengths, self.counts, self.capacity = lengths[order], counts[order], capacity
        self.ends = np.cumsum(self.counts)
        self.containers = 0
        self.takes: list[tuple[int, int, int, int]] = []
        self.rooms: dict[int, list[tuple[int, int]]] = {}
        self.sizes: list[int] = []  # rooms that occur, ascending

    def length_at(self, place: np.ndarray | int) -> np.ndarray:
        return self.lengths[np.searchsorted(self.ends, place, side="right")]

    def leave(self, first: int, last: int, room: int) -> None:
        """Containers from ``first`` to before ``last`` have ``room`` left."""
        if room > 0 and last > first:
            if room not in self.rooms:
                self.rooms[room] = []
                insort(self.sizes, room)
            self.rooms[room].append((first, last))

    def configured(self, groups: int, large: float) -> list[tuple[int, int]]:
        """Places of large documents by configurations; the stretches of places that are left over."""
        n = int(self.counts[self.lengths > large * self.capacity].sum())
        if not n:
            return [(0, int(self.ends[-1]))]
        k = min(groups, n)
        cuts = [n * g // k for g in range(k + 1)]
        # groups of equal cardinality, each rounded up to its largest length; equal sizes fall together
        sizes, froms = [], []
        for c in cuts[:-1]:
            size = int(self.length_at(c))
            if not sizes or sizes[-1] != size:
                sizes.append(size)
                froms.append(c)
        at, stop = froms.copy(), [*froms[1:], n]
        for configuration, uses in configurations(np.array(sizes), np.array([b - a for a, b in zip(froms, stop, strict=True)]), self.capacity):
            kinds = [(k, int(c)) for k, c in enumerate(configuration) if c]
            uses = min(uses, *[(stop[k] - at[k]) // c for k, c in kinds])
            if not uses:
                continue
            # the uses between two changes of a length all leave the same room
            breaks = {0, uses}
            for k, c in kinds:
                inner = self.ends[(self.ends > at[k]) & (self.ends < at[k] + uses * c)] - at[k]
                breaks |= set((inner // c).tolist()) | set((-(-inner // c)).tolist())
                self.takes.append((at[k], at[k] + uses * c, self.containers, c))
            marks = np.array(sorted(breaks))
            held = sum(self.length_at(at[k] + marks[:-1, None] * c + np.arange(c)).sum(1) for k, c in kinds)
            for a, b, h in zip(marks[:-1].tolist(), marks[1:].tolist(), held.tolist(), strict=True):
                self.leave(self.containers + a, self.containers + b, self.capacity - h)
            for k, c in kinds:
                at[k] += uses * c
            self.containers += uses
        return [*[(a, b) for a, b in zip(at, stop, strict=True) if a < b], *([(n, int(self.ends[-1]))] if n < self.ends[-1] else [])]

    def fitted(self, place: int, stop: int) -> None:
        """Best fit of places of one length, as many at once as go the same way."""
        need, end = int(self.length_at(place)), self.containers
        if not need:
            self.takes.append((place, stop, 0, stop - place))  # documents without tokens take no room
            self.containers = max(1, end)
            return
        while place < stop:
            at = bisect_left(self.sizes, need)
            if at == len(self.sizes):
                per = self.capacity // need
                whole, rest = divmod(stop - place, per)
                self.takes.append((place, stop, self.containers, per))
                self.leave(self.containers, self.containers + whole, self.capacity - per * need)
                self.containers += whole
                if rest:
                    self.leave(self.containers, self.containers + 1, self.capacity - rest * need)
                    self.containers += 1
                return
            room = self.sizes[at]
            first, last = self.rooms[room].pop()
            if not self.rooms[room]:
                del self.rooms[room], self.sizes[at]
            per = room // need
            n = min(stop - place, per * (last - first))
            whole, rest = divmod(n, per)
            self.takes.append((place, place + n, first, per))
            self.leave(first, first + whole, room - per * need)
            if rest:
                self.leave(first + whole, first + whole + 1, room - rest * need)
            self.leave(first + whole + bool(rest), last, room)
            place += n

    def rows(self) -> list[tuple[int, int, int, int, int, int]]:
        """(length, rank_from, rank_to, container, shift, per): a document of that length and rank goes to ``container`` +
        (rank + ``shift``) // ``per``."""
        out = []
        for a, b, container, per in self.takes:
            for i in range(int(np.searchsorted(self.ends, a, side="right")), int(np.searchsorted(self.ends, b - 1, side="right")) + 1):
                begin = int(self.ends[i] - self.counts[i])
                out.append((int(self.lengths[i]), max(a, begin) - begin, min(b, int(self.ends[i])) - begin, container, begin - a, per))
        return out


def planned(lengths: np.ndarray, counts: np.ndarray, capacity: int, groups: int = GROUPS, shares: tuple[float, ...] = LARGE) -> Plan:
    """The plan with the fewest containers of those tried; every length is between 0 and ``capacity``, with a count."""
    least = -(-int((lengths * counts).sum()) // capacity)
    best = None
    for large in shares:
        plan = Plan(lengths, counts, capacity)
        # longest first, of what the configurations left and of the small
        for a, b in sorted(plan.configured(groups, large)) if len(lengths) else []:
            while a < b:
                stop = min(b, int(plan.ends[np.searchsorted(plan.ends, a, side="right")]))
                plan.fitted(a, stop)
                a = stop
        if best is None or plan.containers < best.containers:
            best = plan
        if best.containers <= least * (1 + CLOSE) + 1:
            break
    return best


def pack(lengths: np.ndarray, capacity: int, groups: int = GROUPS, shares: tuple[float, ...] = LARGE) -> np.ndarray:
    """The container of each item of an array."""
    sizes, counts = np.unique(lengths, return_counts=True)
    plan = planned(sizes.astype(np.int64), counts.astype(np.int64), capacity, groups, shares)
    place, out = np.argsort(-np.asarray(lengths), kind="stable"), np.empty(len(lengths), np.int64)
    for a, b, container, per in plan.takes:
        out[place[a:b]] = container + np.arange(b - a) // per
    return out


def packed(lengths: DataFrame, capacity: int, ranked_docs: int = RANKED_DOCS) -> DataFrame:
    """A container for every document: (doc_id, piece, from_token, to_token, n_tokens, container, capacity).

    Only a document longer than ``capacity`` is divided, into full containers and one last piece. One histogram of the
    last pieces' lengths, at most ``capacity`` rows, goes to the driver; the plan that comes back is broadcast, and its
    size depends on the capacity alone. Documents of one length are ranked in parts of about ``ranked_docs`` by a hash
    of their id, so that a length that most documents have is spread; of texts only lengths are moved. The containers
    don't depend on the number of parts. Empty documents take no room and share the first container. An empty table
    gives no rows. ``lengths`` is read three times: write it first.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least one token")
    spark = lengths.sparkSession
    whole = F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / capacity) - 1).cast("bigint")
    cut = lengths.select("doc_id", "n_tokens", whole.alias("whole")).withColumn("rest", F.col("n_tokens") - F.col("whole") * capacity)
    hist = cut.groupBy("rest").agg(F.count(F.lit(1)).alias("n")).collect()
    plan = planned(np.array([r.rest for r in hist], np.int64), np.array([r.n for r in hist], np.int64), capacity)
    parts = max(1, -(-max([r.n for r in hist], default=0) // ranked_docs))
    keyed = cut.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
    local = keyed.withColumn("_n", F.row_number().over(Window.partitionBy("rest", "part").orderBy("doc_id")) - 1)
    if parts > 1:
        before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = keyed.groupBy("rest", "part").agg(F.count(F.lit(1)).alias("_k")).withColumn("_before", F.coalesce(F.sum("_k").over(before), F.lit(0))).drop("_k")
        local = local.join(offsets, ["rest", "part"]).withColumn("_n", F.col("_n") + F.col("_before"))
    table = F.broadcast(spark.createDataFrame(plan.rows(), "rest bigint, rank_from bigint, rank_to bigint, first bigint, shift bigint, per bigint"))
    placed = local.join(table, (local["rest"] == table["rest"]) & (local["_n"] >= table["rank_from"]) & (local["_n"] < table["rank_to"]))
    number = (F.col("first") + F.floor((F.col("_n") + F.col("shift")) / F.col("per"))).cast("string")
    pieces = placed.select("doc_id", "n_tokens", "whole", number.alias("number"), F.explode(F.sequence(F.lit(0), F.col("whole"))).alias("p"))
    last, start = F.col("p") == F.col("whole"), F.col("p") * capacity
    stop = F.when(last, F.col("n_tokens")).otherwise(start + capacity)
    name = F.when(last, F.concat(F.lit("c"), "number")).otherwise(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit("-"), F.col("p").cast("string")))
    return pieces.select(
        "doc_id", F.col("p").cast("int").alias("piece"), start.cast("bigint").alias("from_token"), stop.cast("bigint").alias("to_token"),
        (stop - start).cast("bigint").alias("n_tokens"), name.alias("container"), F.lit(capacity).cast("int").alias("capacity"),
    )


def fill_containers(documents: DataFrame, capacity: int = 2048, path: str | None = None) -> DataFrame:
    """Every document of a table measured in tokens and packed; see ``packed``."""
    return packed(written(token_lengths(documents, path), "lengths"), capacity)


def room_left(assignment: DataFrame) -> DataFrame:
    """Containers, tokens held and the share of room left unused, by capacity."""
    held = assignment.groupBy("capacity", "container").agg(F.sum("n_tokens").alias("n")).where("n > 0")
    sums = held.groupBy("capacity").agg(F.count(F.lit(1)).alias("containers"), F.sum("n").alias("tokens"))
    return sums.withColumn("unused", 1 - F.col("tokens") / (F.col("containers") * F.col("capacity")))
