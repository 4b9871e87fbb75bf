"""Trees of whole traces inside a task, many traces at a time as columns.

Rows come sorted by trace, so a stretch of whole traces is at hand after each few batches. Parents are
looked up by number, and trees are walked level by level over all traces of the stretch at once. Traces too
long for a task, and rows with nulls, do not come here: :mod:`logloom.operators.tree` walks them by joins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STRETCH, STRETCH_BYTES = 100_000, 64 << 20
HOPS = 1 << 20

PART_TYPE = pa.schema(
    {
        "path": pa.list_(pa.struct({"service": pa.string(), "name": pa.string()})),
        "samples": pa.int64(),
        "traces": pa.int64(),
        "offsets": pa.decimal128(38, 0),
        "durations": pa.decimal128(38, 0),
        "min_offset_ns": pa.int64(),
        "max_end_ns": pa.int64(),
        "errors": pa.int64(),
    }
)
PARTS = (
    "path array<struct<service:string,name:string>>, samples bigint, traces bigint, offsets decimal(38,0), "
    "durations decimal(38,0), min_offset_ns bigint, max_end_ns bigint, errors bigint"
)


def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches as tables of whole traces; rows of a trace lie together."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    least = STRETCH
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= least or size >= STRETCH_BYTES * least // STRETCH:
            table = pa.Table.from_batches(held).combine_chunks()
            own = pc.sum(pc.equal(table["trace_id"], table["trace_id"][-1])).as_py()  # of the trace that may go on
            if own < rows:
                yield table.slice(0, rows - own)
                table, least = table.slice(rows - own), STRETCH
            else:
                least *= 2
            held, rows, size = table.to_batches(), table.num_rows, table.nbytes
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _numbers(table: pa.Table, column: str) -> np.ndarray:
    return table[column].to_numpy()


def _ranks(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Texts as numbers that order as their bytes do, the same for equal texts of all columns."""
    coded = pa.concat_arrays([chunk for c in columns for chunk in c.chunks]).dictionary_encode()
    rank = np.empty(len(coded.dictionary), np.int64)
    rank[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(rank))
    return np.split(rank[coded.indices.to_numpy()], np.cumsum([len(c) for c in columns])[:-1])


def _firsts(key: np.ndarray) -> np.ndarray:
    """Whether each of the sorted keys differs from the one before."""
    return np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)


def _checked(result: np.ndarray, wrapped: np.ndarray) -> np.ndarray:
    if (wrapped < 0).any():
        raise OverflowError("a time of a span is out of the range of 64 bits")
    return result


def _minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    c = a - b
    return _checked(c, (a ^ b) & (a ^ c))


def _plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    c = a + b
    return _checked(c, (a ^ c) & (b ^ c))


class Forest:
    """The spans of a stretch, one of each (trace, span id): the first by ``order``; without id all stay.

    ``rows`` are their places in the table, ``trace`` their trace's number, ``up`` the place of the parent
    among them or -1.
    """

    def __init__(self, table: pa.Table, order: list[str]) -> None:
        ids = table["trace_id"].combine_chunks()
        new = pc.not_equal(ids.slice(1), ids.slice(0, len(ids) - 1)).to_numpy(zero_copy_only=False)
        trace = np.concatenate(([0], np.cumsum(new)))
        span, parent = _ranks(table["span_id"], table["parent_span_id"])
        named = pc.not_equal(table["span_id"], "").to_numpy()
        ids_known = max(span.max(), parent.max()) + 1
        key = trace * ids_known + span
        keep = np.ones(len(key), bool)
        by_key = np.flatnonzero(named)[np.argsort(key[named], kind="stable")]
        same = ~_firsts(key[by_key])
        if same.any():
            again = by_key[same | np.concatenate((same[1:], [False]))]
            texts = [table[c].type == pa.string() for c in order]
            values = [_ranks(table[c])[0][again] if t else _numbers(table, c)[again] for c, t in zip(order, texts, strict=True)]
            again = again[np.lexsort((*reversed(values), key[again]))]
            keep[again[~_firsts(key[again])]] = False
            by_key = by_key[keep[by_key]]
        self.rows = np.flatnonzero(keep)
        place = np.cumsum(keep) - 1
        self.trace, self.span, self.traces = trace[keep], span[keep], int(trace[-1]) + 1
        above = self.trace * ids_known + parent[keep]
        known = key[by_key]
        at = np.searchsorted(known, above)
        at[at == len(known)] = 0
        self.up = np.where(known[at] == above, place[by_key[at]], -1) if len(known) else np.full(len(self.rows), -1)

    def earliest(self, *keys: np.ndarray) -> np.ndarray:
        """Of each trace the place of the span with the smallest keys, first key first."""
        order = np.lexsort((*reversed(keys), self.trace))
        return order[_firsts(self.trace[order])]

    def levels(self, top: np.ndarray, *keys: np.ndarray) -> Iterator[np.ndarray]:
        """Places of the spans at each depth below the tops, siblings together and in order of the keys."""
        own = np.arange(len(self.up))
        kids = np.flatnonzero(~top & (self.up >= 0) & (self.up != own))
        kids = kids[np.lexsort((*(k[kids] for k in reversed(keys)), self.up[kids]))]
        count = np.bincount(self.up[kids], minlength=len(own))
        first = np.cumsum(count) - count
        level = np.flatnonzero(top)
        level = level[np.lexsort((*(k[level] for k in reversed(keys)), self.trace[level]))]
        while len(level):
            yield level
            n = count[level]
            level = kids[np.repeat(first[level] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def shape_parts(order: list[str], match: bool) -> Callable:
    """Per stretch, what :func:`logloom.operators.tree.shape_rows` merges: a row per path below the anchors.

    Besides the spans' columns ``_error`` and, with ``match``, ``_match`` are read.
    """

    def parts(table: pa.Table) -> Iterator[pa.RecordBatch]:
        forest = Forest(table, order)
        rows = forest.rows
        start, duration = _numbers(table, "start_ns")[rows], _numbers(table, "duration_ns")[rows]
        choice = np.where(forest.up < 0, 1, 2)
        if match:
            choice[_numbers(table, "_match")[rows]] = 0
        anchor = forest.earliest(choice, start, forest.span)[forest.trace]
        top = (start == start[anchor]) & (forest.span == forest.span[anchor])
        service, name = table["service"].combine_chunks().dictionary_encode(), table["name"].combine_chunks().dictionary_encode()
        hops, hop = np.unique(
            service.indices.to_numpy()[rows].astype(np.int64) * len(name.dictionary) + name.indices.to_numpy()[rows], return_inverse=True
        )
        path, known, seen = np.zeros(len(rows), np.int64), 0, []
        above_of, hop_of, length_of = [], [], []
        for depth, level in enumerate(forest.levels(top)):
            above = path[forest.up[level]] if depth else np.zeros(len(level), np.int64)
            found, number = np.unique(above * len(hops) + hop[level], return_inverse=True)
            path[level] = known + number
            above_of.append(found // len(hops) if depth else np.full(len(found), -1))
            hop_of.append(hops[found % len(hops)])
            length_of.append(np.full(len(found), depth + 1))
            known += len(found)
            seen.append(level)
        above, hop, length = np.concatenate(above_of), np.concatenate(hop_of), np.concatenate(length_of)
        below = np.concatenate(seen)
        below = below[np.lexsort((forest.trace[below], path[below]))]
        number, trace = path[below], forest.trace[below]
        first = _firsts(number)
        starts = np.flatnonzero(first)
        zero = start[below] == 0
        since = np.where(zero, 0, np.maximum(_minus(np.where(zero, 0, start[below]), np.where(zero, 0, start[anchor[below]])), 0))
        lasted = np.maximum(duration[below], 0)

        def whole(x: np.ndarray) -> pa.Array:
            high, low = np.add.reduceat(x >> 32, starts).tolist(), np.add.reduceat(x & 0xFFFFFFFF, starts).tolist()
            return pa.array([Decimal((h << 32) + w) for h, w in zip(high, low, strict=True)], pa.decimal128(38, 0))

        sums = [
            pa.array(np.diff(np.append(starts, len(below)))),
            pa.array(np.add.reduceat((first | _firsts(trace)).astype(np.int64), starts)),
            whole(since),
            whole(lasted),
            pa.array(np.minimum.reduceat(since, starts)),
            pa.array(np.maximum.reduceat(_plus(since, lasted), starts)),
            pa.array(np.add.reduceat(_numbers(table, "_error")[rows][below].astype(np.int64), starts)),
        ]
        kind = PART_TYPE.field("path").type
        upto = np.cumsum(length)
        at = 0
        while at < known:  # long paths make many small batches
            end = max(at + 1, int(np.searchsorted(upto, upto[at] + HOPS)))
            ends = np.concatenate(([0], np.cumsum(length[at:end])))
            flat, place, now = np.empty(ends[-1], np.int64), ends[1:] - 1, np.arange(at, end)
            while len(now):
                flat[place] = hop[now]
                place, now = place[above[now] >= 0] - 1, above[now][above[now] >= 0]
            named = [d.take(pa.array(i)) for d, i in zip((service.dictionary, name.dictionary), np.divmod(flat, len(name.dictionary)), strict=True)]
            structs = pa.StructArray.from_arrays(named, fields=list(kind.value_type))
            found = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), structs, type=kind)
            yield pa.RecordBatch.from_arrays([found, *(x.slice(at, end - at) for x in sums)], schema=PART_TYPE)
            at = end

    return lambda batches: (part for table in stretches(batches) for part in parts(table))


def display_order(order: list[str]) -> Callable:
    """Per stretch, the spans that hang below a top, with ``position`` and ``depth``, in display order."""

    def within(size: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Of each row the sizes of the rows before it in its group; groups lie together."""
        before = np.cumsum(size) - size
        first = _firsts(group)
        return before - before[np.flatnonzero(first)[np.cumsum(first) - 1]]

    def rows_of(table: pa.Table) -> pa.RecordBatch:
        forest = Forest(table, order)
        start, duration = _numbers(table, "start_ns")[forest.rows], _numbers(table, "duration_ns")[forest.rows]
        root = forest.up < 0
        rootless = np.bincount(forest.trace[root], minlength=forest.traces) == 0
        first = forest.earliest(start, forest.span)[forest.trace]
        top = root | (rootless[forest.trace] & (start == start[first]) & (forest.span == forest.span[first]))
        levels = list(forest.levels(top, start, duration, forest.span))
        size, position, depth = np.ones(len(start), np.int64), np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        for level in reversed(levels[1:]):
            np.add.at(size, forest.up[level], size[level])
        position[levels[0]] = 1 + within(size[levels[0]], forest.trace[levels[0]])
        for d, level in enumerate(levels[1:], 1):
            above = forest.up[level]
            position[level] = position[above] + 1 + within(size[level], above)
            depth[level] = d
        shown = np.concatenate(levels)
        shown = shown[np.lexsort((position[shown], forest.trace[shown]))]
        out = table.take(pa.array(forest.rows[shown]))
        out = out.append_column("position", pa.array(position[shown])).append_column("depth", pa.array(depth[shown]))
        return out.combine_chunks().to_batches()[0]

    return lambda batches: map(rows_of, stretches(batches))
