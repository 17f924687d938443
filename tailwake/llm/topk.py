"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Vectors become integers. Rows are gathered into blocks as they are read, each kept as postings: for
every term (component) the rows where it is not zero, and their weights. Every query block meets
every candidate block once; a term at a time, each query with that term scatters its weight times
the posting weights into its dense score array. Partition selection keeps the k best of the pair of
blocks, out of the scores that reach the k-th best so far, and the few kept rows of each query are
merged.

Blocks are dealt to slots by a number that has nothing to do with ids, and each pair of a query slot
and a candidate slot is a cell. Both sides reach the cells by one shuffle, never by a join, so no
copies pass through the driver. A cell holds the queries of its slot and their k best (about
``QUERY_BYTES``) and one candidate block at a time. Candidates are copied once for each query slot,
queries once for each candidate slot, in the narrowest type that holds a block; there are few slots,
as many as memory and tasks ask for, not one for each block. Beyond those sizes copies, like the
work, grow with the square of the rows. Queries are a stated set against all rows, in blocks.

Defined cases: vectors that are null, empty, or hold null or non-finite components, and rows with a
null id, take no part. A candidate with the query's id is left out as its own. Rows that repeat an id
are candidates each; of queries that share an id the smallest vector counts. Vectors of different
lengths are compared over their common components. Ties go to the smaller id. Fewer than k
candidates give as many rows. An empty table gives none. Scores are 64-bit integers.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tailwake.sources.workspace import materialize

K = 20
SCALE = 64
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 8192
#: Components in a block, counted as long as its longest vector.
BLOCK_VALUES = 1 << 22
#: Queries whose score arrays are held at a time.
LANES = 16
#: Rows of a slot.
QUERY_SLOT = 16_384
CANDIDATE_SLOT = 131_072
#: Bytes of a slot: of queries with their best, which a cell holds, and of candidates, which pass by.
QUERY_BYTES = 32 << 20
CANDIDATE_BYTES = 64 << 20
#: Pairs of rows that are worth a task of their own, and a task's share of the cores.
CELL_PAIRS = 1 << 24
CELLS_A_CORE = 4
#: Tasks that cells are dealt to, at most.
TASKS = 8192
LOWEST = int(np.iinfo(np.int64).min)


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (id, values) as blocks of at most ``size``: ids, lengths and values in binary, by id. With a
    number to deal them by, the rows, the bytes as a matrix, and the width of a value."""
    names = ["place", "n", "size", "width", "ids", "lengths", "values"]
    kinds = [pa.int64()] * 4 + [pa.binary()] * 3
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray]] = []
        longest = 0
        # Blocks of a partition are dealt in turn, from a start of its own.
        place = zlib.crc32(str(TaskContext.get().partitionId()).encode())

        def flush() -> pa.RecordBatch:
            nonlocal place, longest
            held.sort(key=lambda row: row[0])
            ids = np.array([i for i, _ in held], np.int64)
            lengths = np.array([len(v) for _, v in held], np.int32)
            values = np.concatenate([v for _, v in held]).astype(np.int64)
            values = values.astype(narrowest(values))
            width = values.dtype.itemsize
            row = [place, len(held), len(held) * (longest * width + 12), width]
            row += [x.tobytes() for x in (ids, lengths, values)]
            held.clear()
            place, longest = place + 1, 0
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, kinds, strict=True)], schema=schema
            )

        for part in parts:
            for i, values in zip(*part.columns, strict=True):
                vector = values.values.to_numpy(zero_copy_only=False)
                if held and (len(held) + 1) * max(longest, len(vector)) > BLOCK_VALUES:
                    yield flush()
                held.append((i.as_py(), vector))
                longest = max(longest, len(vector))
                if len(held) == size:
                    yield flush()
        if held:
            yield flush()

    return rows.select("id", "values").mapInArrow(
        run,
        "place long, n long, size long, width long, ids binary, lengths binary, values binary",
    )


def narrowest(values: np.ndarray) -> type:
    low, high = values.min(), values.max()
    fits = (t for t in (np.int8, np.int16, np.int32) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return next(fits, np.int64)


def integers(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, values): finite vectors as integers floor(scale * x)."""
    x = F.col("vector")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        rows.select(
            F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")
        )
        .where(F.col("id").isNotNull() & x.isNotNull() & (F.size(x) > 0))
        .where(F.coalesce(finite, F.lit(False)))
        .select("id", F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("values"))
    )


def _matrix(width: int, lengths: bytes, values: bytes) -> np.ndarray:
    sizes = np.frombuffer(lengths, np.int32)
    flat = np.frombuffer(values, np.dtype(f"i{width}"))
    full = np.zeros((len(sizes), sizes.max()), flat.dtype)
    full[np.arange(full.shape[1]) < sizes[:, None]] = flat
    return full


def nth(scores: np.ndarray, n: int) -> np.generic:
    """The n-th best score."""
    return np.partition(scores, len(scores) - n)[len(scores) - n]


def best(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, candidates: np.ndarray, k: int,
    least: list[int] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, candidate id, score) of each query's k best in one block; ``ids`` ascend. Scores below
    the query's ``least`` are passed over."""
    terms = min(queries.shape[1], candidates.shape[1])
    queries, candidates = queries[:, :terms], candidates[:, :terms]
    # No sum of products, whole or in part, exceeds the product of the lengths.
    lengths = [np.sqrt((m.astype(np.float64) ** 2).sum(axis=1)).max(initial=0) for m in (queries, candidates)]
    bound = 1.01 * lengths[0] * lengths[1] + 1
    kind = next((t for t in (np.int16, np.int32) if bound < np.iinfo(t).max), np.int64)
    full = 2 * np.count_nonzero(candidates, axis=0) > len(ids)  # most rows have the term: no list is needed
    dense = np.ascontiguousarray(candidates[:, full].T, kind)
    every = iter(dense)
    postings = []
    for t in range(terms):
        if full[t]:
            postings.append((slice(None), next(every)))
        else:
            rows = np.flatnonzero(candidates[:, t])
            postings.append((rows, candidates[rows, t].astype(kind)))
    own = [np.searchsorted(ids, query_ids, side).tolist() for side in ("left", "right")]
    counts = np.zeros(len(queries), np.int64)
    out = []
    for at in range(0, len(queries), LANES):
        lane = queries[at : at + LANES].astype(kind)
        most = 2 * np.count_nonzero(lane, axis=0) > len(lane)
        # Terms of most rows and most queries, one after another: multiplied and added in one pass.
        wanted = most[full]
        scores = np.einsum("qt,tn->qn", lane[:, full & most], dense if wanted.all() else dense[wanted])
        for t in np.flatnonzero(~(full & most) & lane.any(axis=0)):
            rows, weights = postings[t]
            for q in np.flatnonzero(lane[:, t]):
                scores[q, rows] += lane[q, t] * weights
        for q, row in enumerate(scores, at):
            hits = np.arange(len(ids)) if least is None else (row >= least[q]).nonzero()[0]
            if own[0][q] < own[1][q]:
                hits = hits[(hits < own[0][q]) | (hits >= own[1][q])]
            take = min(k, len(hits))
            if not take:
                continue
            reached = row[hits]
            if take < len(hits):  # the k-th best of some rows is not above the k-th best of all
                near = (reached >= nth(reached[: 32 * k], take)).nonzero()[0]
                hits, reached = hits[near], reached[near]
                limit = nth(reached, take)
                above = np.flatnonzero(reached > limit)
                level = np.flatnonzero(reached == limit)[: take - len(above)]
                chosen = np.concatenate([above, level])
                hits, reached = hits[chosen], reached[chosen]
            counts[q] = take
            out.append((ids[hits], reached.astype(np.int64)))
    if not out:
        return (np.empty(0, np.int64),) * 3
    return np.repeat(query_ids, counts), *(np.concatenate(c) for c in zip(*out, strict=True))


def merged(found: tuple, more: tuple, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of each query out of both, by query, score and id."""
    query_ids, ids, scores = (np.concatenate(c) for c in zip(found, more, strict=True))
    order = np.lexsort((ids, ~scores, query_ids))
    ordered = query_ids[order]
    order = order[np.arange(len(order)) - np.searchsorted(ordered, ordered) < k]
    return query_ids[order], ids[order], scores[order]


class Asked:
    """Queries with different ids, and the k best of each among the candidate blocks met so far."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]], k: int):
        ids = np.concatenate([i for i, _ in parts])
        order = np.argsort(ids)
        kind = np.result_type(*[m.dtype for _, m in parts])
        matrix = np.zeros((len(ids), max(m.shape[1] for _, m in parts)), kind)
        at = 0
        for _, m in parts:
            matrix[at : at + len(m), : m.shape[1]] = m
            at += len(m)
        self.ids, self.matrix, self.k = ids[order], matrix[order], k
        self.found = (np.empty(0, np.int64),) * 3
        self.least = np.full(len(ids), LOWEST)

    def meet(self, ids: np.ndarray, candidates: np.ndarray) -> None:
        more = best(self.ids, self.matrix, ids, candidates, self.k, self.least.tolist())
        if not len(more[0]):
            return
        self.found = merged(self.found, more, self.k)
        begin, end = (np.searchsorted(self.found[0], self.ids, side) for side in ("left", "right"))
        full = end - begin == self.k
        self.least[full] = self.found[2][end[full] - 1]


def gathered(parts: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[Asked]:
    """Query blocks joined as far as a block may go."""
    out, held, rows, longest = [], [], 0, 0
    for ids, matrix in parts:
        rows, longest = rows + len(ids), max(longest, matrix.shape[1])
        if held and rows * longest > BLOCK_VALUES:
            out.append(Asked(held, k))
            held, rows, longest = [], len(ids), matrix.shape[1]
        held.append((ids, matrix))
    return [*out, Asked(held, k)] if held else out


def searched(parts: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(query_id, vec_id, score) of each cell: its query blocks come first, then its candidate blocks."""
    cell, asked, blocks = None, [], []

    def flush() -> Iterator[pa.RecordBatch]:
        for group in asked:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in group.found], names=["query_id", "vec_id", "score"]
            )

    for part in parts:
        for row in range(part.num_rows):
            of, candidates, width, ids, lengths, values = (c[row].as_py() for c in part.columns)
            if of != cell:
                yield from flush()
                cell, asked, blocks = of, [], []
            block = np.frombuffer(ids, np.int64), _matrix(width, lengths, values)
            if not candidates:
                blocks.append(block)
                continue
            if blocks:
                asked, blocks = gathered(blocks, k), []
            for group in asked:
                group.meet(*block)
    yield from flush()


def slots(asked: int, asked_bytes: int, rows: int, row_bytes: int, k: int, cores: int) -> tuple[int, int]:
    """Slots of queries and of candidates: none above its limit, cells enough for the cores where there
    is work for them, and of such grids the one that copies the fewest bytes."""
    asked_bytes += 24 * k * asked  # a candidate slot more copies the queries, and gives k rows more for each
    least = max(1, math.ceil(asked / QUERY_SLOT), math.ceil(asked_bytes / QUERY_BYTES))
    cells = max(1, min(CELLS_A_CORE * cores, asked * rows // CELL_PAIRS))
    query_slots = max(least, min(cells, round(math.sqrt(cells * asked_bytes / max(1, row_bytes)))))
    least = max(1, math.ceil(rows / CANDIDATE_SLOT), math.ceil(row_bytes / CANDIDATE_BYTES))
    return query_slots, max(least, math.ceil(cells / query_slots))


def top_k(
    rows: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id",
    vector_col: str = "embedding", scale: int = SCALE,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score."""
    asked = integers(queries, id_col, vector_col, scale).groupBy("id").agg(F.min("values").alias("values"))
    left = materialize(blocks(asked, QUERY_BLOCK), "queries")
    right = materialize(blocks(integers(rows, id_col, vector_col, scale), CANDIDATE_BLOCK), "candidates")
    sizes = [side.agg(F.sum("n"), F.sum("size")).first() for side in (left, right)]
    cores = rows.sparkSession.sparkContext.defaultParallelism
    across, along = slots(*[x or 0 for size in sizes for x in size], k, cores)

    def dealt(side: DataFrame, candidates: bool) -> DataFrame:
        own = F.pmod("place", F.lit(along if candidates else across))
        other = F.explode(F.sequence(F.lit(0), F.lit((across if candidates else along) - 1)))
        return side.select("*", own.alias("own"), other.alias("other")).select(
            (F.col("other") * along + F.col("own") if candidates else F.col("own") * along + F.col("other"))
            .cast("long").alias("cell"),
            F.lit(candidates).alias("candidates"), "width", "ids", "lengths", "values",
        )

    tasks = min(TASKS, across * along)
    cells = (
        dealt(left, False).union(dealt(right, True))
        .repartitionById(tasks, F.pmod("cell", F.lit(tasks)).cast("int"))
        .sortWithinPartitions("cell", "candidates")
    )
    kept = cells.mapInArrow(lambda parts: searched(parts, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        kept.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
