"""Continuous periods, gaps and multiply covered stretches of intervals.

Time is cut into exact units (whole milliseconds) and into shards of ``SHARD`` units per entity. The rows of a shard are
united into two compressed run bitmaps, "covered" and "covered twice or more": sorted runs of set units that neither
overlap nor touch, at most ``SHARD`` / 2 of them however many rows there are. Set runs and clear runs within a shard are
results; only the runs at its ends go on to be joined with those of the entity's other shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Units of a time shard.
SHARD = 1 << 16
#: Shards that a row is cut into at most; of a longer one the whole shards inside stay one stretch.
CUT = 64


def to_ms(seconds: Column) -> Column:
    """Whole milliseconds, null for a missing or infinite bound."""
    value = seconds.cast("double")
    return F.when(F.abs(value) < F.lit(9e12), F.floor(value * 1000 + F.lit(0.5)))


def _groups(columns: list[pa.Array]) -> np.ndarray:
    """True at each row whose key differs from the row before (null equals null)."""
    n = len(columns[0])
    new = np.zeros(n, dtype=bool)
    if n:
        new[0] = True
    for c in columns:
        if c.null_count:
            null = np.asarray(c.is_null())
            new[1:] |= null[1:] != null[:-1]
        differ = pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, n - 1)), False)
        new[1:] |= np.asarray(differ)
    return new


def _take(batch: pa.RecordBatch, keys: list[str], at: np.ndarray) -> list[pa.Array]:
    return [batch.column(k).take(pa.array(at)) for k in keys]


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def united(group: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[Runs, Runs]:
    """The run bitmaps "covered" and "covered twice or more" of each group's rows, each as (group, from, to), ordered.

    Bitmaps of a part of the rows take part in a further union as rows of their own: a unit is in neither, in the first
    or in both, which is how often it counts.
    """
    at, of = np.concatenate([lo, hi]), np.concatenate([group, group])
    step = np.concatenate([np.ones(len(lo), np.int64), -np.ones(len(hi), np.int64)])
    order = np.lexsort((step, at, of))  # ends first: rows that merely touch share nothing
    at, of, level = at[order], of[order], np.cumsum(step[order])
    before = level - step[order]

    def runs(depth: int) -> Runs:
        rise, fall = (before < depth) & (level >= depth), (before >= depth) & (level < depth)
        g, a, b = of[rise], at[rise], at[fall]
        apart = np.ones(len(g) + 1, bool)
        apart[1:-1] = (g[1:] != g[:-1]) | (a[1:] != b[:-1])  # runs that touch are one
        return g[apart[:-1]], a[apart[:-1]], b[apart[1:]]

    return runs(1), runs(2)


def _names(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)


def shard_runs(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Periods, gaps and overlaps of each entity and time shard: (keys, shard, kind, from_ms, to_ms, border).

    ``pieces`` has keys, shard, id, lo and hi, cut to the shard. ``border`` is 0 for what other shards cannot change, 1 for
    runs at the ends of a shard, and 2 for such a run with which the gap before it has been given already. Rows of one id
    and equal bounds count once. Rows stream through: of a shard that spans several batches only its bitmaps are kept.
    """
    cut = pieces.withColumn("_key", F.xxhash64(*keys, "shard")).repartition("_key").sortWithinPartitions("_key", *keys, "shard", "lo", "hi", "id")
    group = ["_key", *keys, "shard"]
    schema = _names(pieces, keys) + ", shard bigint, kind string, from_ms bigint, to_ms bigint, border int"

    def results(head: pa.RecordBatch, one: Runs, two: Runs) -> Iterator[pa.RecordBatch]:
        """The results of whole groups; ``head`` has a row for each."""
        shard = _column(head, "shard")
        g, a, b = one
        first = np.append(True, g[1:] != g[:-1])[: len(g)]
        last = np.append(g[1:] != g[:-1], True)[: len(g)]
        inner = ~first
        parts = [("period", g, a, b, np.where(first, 1, np.where(last, 2, 0))), ("gap", g[inner], b[:-1][inner[1:]], a[inner], np.zeros(int(inner.sum()), np.int64))]
        g, a, b = two
        parts.append(("overlap", g, a, b, ((a == shard[g] * SHARD) | (b == (shard[g] + 1) * SHARD)).astype(np.int64)))
        for kind, g, a, b, border in parts:
            if len(g):
                columns = [pa.array([kind] * len(g)), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(border, pa.int32())]
                yield pa.RecordBatch.from_arrays([*_take(head, [*keys, "shard"], g), *columns], names=[*keys, "shard", "kind", "from_ms", "to_ms", "border"])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last row of the group that may go on
        kept: tuple[Runs, Runs] | None = None  # its bitmaps
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = _groups([batch.column(k) for k in group])
            a, b, i = (_column(batch, k) for k in ("lo", "hi", "id"))
            keep = np.ones(n, bool)
            keep[1:] = new[1:] | (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (i[1:] != i[:-1])
            goes_on = held is not None and all(held.column(k)[0].as_py() == batch.column(k)[0].as_py() for k in group)
            if goes_on:
                keep[0] = any(held.column(k)[0].as_py() != batch.column(k)[0].as_py() for k in ("lo", "hi", "id"))
            elif held is not None:
                yield from results(held, *kept)
            of = np.cumsum(new) - 1
            g, lo, hi = of[keep], a[keep], b[keep]
            if goes_on:
                g, lo, hi = (np.concatenate([kept[0][k], kept[1][k], x]) for k, x in enumerate((g, lo, hi)))
            bitmaps = united(g, lo, hi)
            heads, last = np.flatnonzero(new), int(of[-1])
            if last:
                yield from results(batch.take(pa.array(heads[:-1])), *[tuple(x[r[0] < last] for x in r) for r in bitmaps])
            held, kept = batch.slice(n - 1), tuple((r[0][r[0] == last] * 0, r[1][r[0] == last], r[2][r[0] == last]) for r in bitmaps)
        if held is not None:
            yield from results(held, *kept)

    return cut.mapInArrow(kernel, schema)


def long_runs(rows: DataFrame, keys: list[str]) -> DataFrame:
    """What rows of keys, id, lo and hi cover once and what twice or more: (keys, lo, hi, depth), disjoint.

    Only the two latest ends are kept along an entity, so that memory does not grow with its rows.
    """
    one = rows.select(*keys, "id", "lo", "hi").distinct().withColumn("_key", F.xxhash64(*keys)).repartition("_key").sortWithinPartitions("_key", *keys, "lo", "hi")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, ends = None, 0, (0, 0)
        for batch in batches:
            out: list[tuple] = []

            def until(at: float, out: list[tuple] = out) -> None:
                for depth, a, b in ((2, now, min(ends[1], at)), (1, max(now, ends[1]), min(ends[0], at))):
                    if a < b:
                        out.append((*key, a, b, depth))

            for *its, lo, hi in zip(*[batch.column(k).to_pylist() for k in (*keys, "lo", "hi")], strict=True):
                if key != its:
                    if key is not None:
                        until(float("inf"))
                    key, now, ends = its, lo, (lo, lo)
                until(lo)
                now, ends = lo, tuple(sorted((*ends, hi))[:0:-1])
            yield from [pa.RecordBatch.from_pylist([dict(zip((*keys, "lo", "hi", "depth"), r, strict=True)) for r in out], schema=kinds(batch))] if out else []
        if key is not None:
            out = []
            until(float("inf"), out)
            yield pa.RecordBatch.from_pylist([dict(zip((*keys, "lo", "hi", "depth"), r, strict=True)) for r in out], schema=kinds(batch))

    def kinds(batch: pa.RecordBatch) -> pa.Schema:
        return pa.schema([*[batch.schema.field(k) for k in keys], ("lo", pa.int64()), ("hi", pa.int64()), ("depth", pa.int32())])

    return one.mapInArrow(kernel, _names(rows, keys) + ", lo bigint, hi bigint, depth int")


def joined_runs(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Runs at the ends of shards joined where they touch, and the gaps between them: (keys, kind, from_ms, to_ms).

    ``parts`` is what ``shard_runs`` gives. Only runs at borders, at most four a shard, gather by entity, and they stream
    through with one run kept; all other results are spread over the shards and pass.
    """
    key = F.when(F.col("border") > 0, F.xxhash64(*keys)).otherwise(F.xxhash64(*keys, "shard"))
    cut = parts.withColumn("_key", key).repartition("_key").sortWithinPartitions("_key", *keys, "kind", "from_ms")
    group = ["_key", *keys, "kind"]
    names = [*keys, "kind", "from_ms", "to_ms"]

    def rows(batch: pa.RecordBatch, at: np.ndarray, a: np.ndarray, b: np.ndarray, kind: str | None = None) -> pa.RecordBatch:
        kinds = pa.array([kind] * len(at), pa.string()) if kind else batch.column("kind").take(pa.array(at))
        return pa.RecordBatch.from_arrays([*_take(batch, keys, at), kinds, pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=names)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the run that may go on
        for batch in batches:
            border = _column(batch, "border")
            if (border == 0).any():
                yield batch.filter(pa.array(border == 0)).select(names)
                batch = batch.filter(pa.array(border > 0))
            if not batch.num_rows:
                continue
            batch = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks().to_batches()[0]
            new, a, b, glued = _groups([batch.column(k) for k in group]), _column(batch, "from_ms"), _column(batch, "to_ms"), _column(batch, "border") == 2
            start = new.copy()
            start[1:] |= a[1:] > b[:-1]
            first = np.flatnonzero(start)
            end = b[np.append(first[1:], len(b)) - 1]
            yield rows(batch, first[:-1], a[first[:-1]], end[:-1])
            period = np.asarray(pc.equal(batch.column("kind"), "period"))
            gap = np.flatnonzero(~new[first[1:]] & ~glued[first[1:]] & period[first[1:]])
            if len(gap):
                yield rows(batch, first[1:][gap], end[:-1][gap], a[first[1:]][gap], "gap")
            one = batch.slice(int(first[-1]), 1)
            held = one.set_column(one.schema.get_field_index("to_ms"), "to_ms", pa.array([end[-1]], pa.int64()))
        if held is not None:
            yield held.select(names)

    return cut.mapInArrow(kernel, _names(parts, keys) + ", kind string, from_ms bigint, to_ms bigint")


def coverage(rows: DataFrame, keys: list[str], id_col: str, start: str, end: str) -> DataFrame:
    """Periods, gaps and overlaps of each entity's intervals, bounds in seconds rounded to whole milliseconds.

    Returns (keys, kind, from_ms, to_ms). kind ``period``: a maximal covered stretch; ``gap``: a maximal uncovered one
    between the first period and the last; ``overlap``: a maximal stretch covered twice or more. A row counts once per
    id, and only if both bounds are there and the end is after the start; others are left out, as is a row without
    id. Null keys form an entity of their own. An empty table gives no rows. Columns beyond those named are ignored.

    An entity that has most rows is spread over its time shards, and a shard's bitmaps are bounded by ``SHARD``. Rows
    cannot be united before the shuffle, since a row that was delivered twice would then cover its time twice. A row longer
    than ``CUT`` shards is cut at its ends only: what it covers in between is joined to the shards that other rows touch.
    Whether there are such rows is asked first.
    """
    if {"kind", "from_ms", "to_ms"} & set(keys):
        raise ValueError("a key bears the name of a result")
    named, keys = keys, [f"_key_{i}" for i in range(len(keys))]  # names of their own, whatever the caller's are
    rows = rows.select(*[F.col(k).alias(n) for k, n in zip(named, keys, strict=True)], F.col(id_col).alias("_of"), F.col(start).alias("_from"), F.col(end).alias("_to"))
    id_col, start, end = "_of", "_from", "_to"
    a, b = to_ms(F.col(start)), to_ms(F.col(end))
    clean = rows.select(*keys, F.col(id_col).cast("bigint").alias("id"), a.alias("lo"), b.alias("hi")).where("id is not null and lo < hi")
    clean = clean.withColumns({"_first": F.floor(F.col("lo") / SHARD).cast("bigint"), "_last": F.floor((F.col("hi") - 1) / SHARD).cast("bigint")})
    far = F.col("_last") - F.col("_first") > CUT
    shards = F.when(far, F.array("_first", "_last")).otherwise(F.sequence("_first", F.least("_last", F.col("_first") + CUT)))
    pieces = clean.select(*keys, "id", "lo", "hi", F.explode(shards).alias("shard"))
    pieces = pieces.withColumns({"lo": F.greatest("lo", F.col("shard") * SHARD), "hi": F.least("hi", (F.col("shard") + 1) * SHARD)})
    parts = shard_runs(pieces, keys)
    if not rows.where(b - a > CUT * SHARD).isEmpty():
        inner = clean.where(far).select(*keys, "id", ((F.col("_first") + 1) * SHARD).alias("lo"), (F.col("_last") * SHARD).alias("hi"))
        long = long_runs(inner, keys)
        same = F.lit(True)
        for k in keys:
            same = same & F.col(f"p.{k}").eqNullSafe(F.col(f"l.{k}"))
        under = (F.col("p.shard") * SHARD >= F.col("l.lo")) & (F.col("p.shard") * SHARD < F.col("l.hi"))
        # below one long row a period is an overlap; below two, or in place of its own gaps and overlaps, nothing is left
        kind = F.when(F.col("l.depth").isNull(), F.col("p.kind")).when((F.col("l.depth") == 1) & (F.col("p.kind") == "period"), F.lit("overlap"))
        parts = parts.alias("p").join(long.alias("l"), same & under, "left").select(*[F.col(f"p.{k}") for k in keys], "p.shard", kind.alias("kind"), "p.from_ms", "p.to_ms", "p.border").where("kind is not null")
        own = [F.col("lo").alias("from_ms"), F.col("hi").alias("to_ms"), F.lit(1).alias("border")]
        for name, some in (("period", long), ("overlap", long.where("depth = 2"))):
            parts = parts.unionByName(some.select(*keys, F.lit(0).cast("bigint").alias("shard"), F.lit(name).alias("kind"), *own))
    return joined_runs(parts, keys).withColumnsRenamed(dict(zip(keys, named, strict=True)))


def tier_rows(intervals: DataFrame, punct: DataFrame) -> DataFrame:
    """Tier intervals and punctuation anchors as one table of (dataset, stem, tier, id, xmin, xmax)."""
    left = intervals.select("dataset", "stem", F.lower("tier").alias("tier"), F.col("interval_id").alias("id"), "xmin", "xmax")
    right = punct.select("dataset", "stem", F.lit("punct").alias("tier"), F.col("punct_id").alias("id"), F.col("start_s").alias("xmin"), F.col("end_s").alias("xmax"))
    return left.unionByName(right)
