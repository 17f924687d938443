"""SimHash near-duplicates by a Gray-order hierarchical index.

A fingerprint has 64 bits: bit b is set if it is set in more than half of the XXH64 values of a
text's word shingles. Two fingerprints link if they differ in at most ``max_bits`` bits.

The index is a tree of masked bit patterns. Its upper nodes are spread over the cluster: the 64 bits
are cut into ``max_bits + 2`` fields, and each choice of two fields is a mask. Linked fingerprints
agree on at least two fields, so they share an upper node (mask, pattern) with an accumulated
difference of zero under at least one mask; a node with a single fingerprint is dropped. Below an
upper node the fingerprints are sorted by Gray rank, so that neighbours share bits. Each run of
eight becomes a node that holds the bits all of them agree on, runs of eight nodes become a node
above, and a bit that a node holds is not looked at again below it. A search goes down the tree with
the differences added up so far and drops a whole node as soon as they exceed ``max_bits``.

Work and memory: distinct fingerprints only, so copies cost nothing. An upper node with more than
``node_size`` fingerprints is cut into parts by hash and each pair of parts becomes a node of its
own, so that no task holds an unbounded node and no link is lost. A node gives out a spanning
forest of its links, never all pairs. Components come from alternating large-star and small-star
rounds over the links, each round written to the shared folder.

Defined cases: null and empty texts have fingerprint zero and link as any other. A text of fewer
words than a shingle is one shingle. A null doc_id is never the smallest of a component unless all
are null. Repeated rows each get their result. An empty table gives an empty result. Only doc_id and
text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailwake.llm.common import words_of
from tailwake.sources.workspace import materialize

SHINGLE = 4
MAX_BITS = 4
SEED = 42
NODE_SIZE = 4096
FANOUT = 8
#: Pairs of a query and a node that a search holds at a time.
FRONTIER = 2_000_000


# -- fingerprints --------------------------------------------------------------------------------


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = max(1, len(words) - shingle + 1)
    stops = ends[min(shingle, len(words)) - 1 :]
    votes = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, count, 65_536):
        part = zip(starts[at : at + 65_536].tolist(), stops[at : at + 65_536].tolist(), strict=False)
        values = np.array([hashed(joined[a:b], SEED) for a, b in part], dtype=">u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > count).tobytes(), "big")


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, doc_id="doc_id", text="text", key: Column | None = None
) -> DataFrame:
    """doc_id, ``key`` (any text that names the row) and ``bits``, the fingerprint as a signed 64-bit
    number; one row per row of ``docs``."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("bits", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [fingerprint(t.as_py(), shingle) for t in part.column("text")]
            bits = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("key"), bits], schema=schema
            )

    chosen = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.lit(None).cast("string") if key is None else key).alias("key"),
        F.col(text).alias("text"),
    )
    return chosen.mapInArrow(run, "doc_id long, key string, bits long")


# -- the index -----------------------------------------------------------------------------------


def gray_rank(bits: np.ndarray) -> np.ndarray:
    """Place of each value in the reflected Gray code."""
    rank = bits.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _unite(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Join the sets of ``left`` and ``right``; every label stays the smallest member of its set."""
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]


def linked(group: np.ndarray, bits: np.ndarray, max_bits: int) -> np.ndarray:
    """For each fingerprint the position of the one that stands for its linked set. ``group`` is
    the upper node of each; both arrays are sorted by group, then Gray rank."""
    n = len(bits)
    label = np.arange(n)
    if n < 2:
        return label
    # From the leaves up: what all members of a node agree on, and where its children begin.
    agree, shared = np.full(n, ~np.uint64(0)), bits
    first, owner = np.arange(n), group
    levels = []
    while True:
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        inside = np.arange(len(owner)) - np.repeat(starts, np.diff(np.r_[starts, len(owner)]))
        opens = np.flatnonzero(inside % FANOUT == 0)
        ones = np.bitwise_and.reduceat(shared & agree, opens)
        any_one = np.bitwise_or.reduceat(shared & agree, opens)
        above = np.bitwise_and.reduceat(agree, opens) & ~(ones ^ any_one)
        size = np.diff(np.r_[opens, len(owner)])
        below = agree & ~np.repeat(above, size)  # bits that the child adds to its parent's
        last = np.r_[first[1:], n] - 1
        levels.append((opens, size, below, shared, last))
        agree, shared, first, owner = above, ones, first[opens], owner[opens]
        if len(owner) == len(starts):
            break
    begin = first
    members = np.diff(np.r_[begin, n])
    root = np.repeat(np.arange(len(begin)), members)
    load = np.cumsum(members[root])
    cuts = np.searchsorted(load, np.arange(FRONTIER, load[-1] + FRONTIER, FRONTIER), side="left") + 1
    start = 0
    for stop in np.unique(np.minimum(cuts, n)):
        query, node = np.arange(start, stop), root[start:stop]
        spent = np.zeros(len(query), np.int64)
        for opens, size, below, pattern, last in reversed(levels):
            width = size[node]
            child = np.repeat(opens[node] - np.cumsum(width) + width, width) + np.arange(width.sum())
            query, spent = np.repeat(query, width), np.repeat(spent, width)
            spent = spent + np.bitwise_count((bits[query] ^ pattern[child]) & below[child])
            near = (spent <= max_bits) & (last[child] > query)
            query, node, spent = query[near], child[near], spent[near]
        _unite(label, query, node)
        start = stop
    return label


def links(bits: DataFrame, max_bits: int = MAX_BITS, node_size: int = NODE_SIZE) -> DataFrame:
    """Spanning links (a, b) between the distinct fingerprints in column ``bits``: every linked pair
    is joined by a path of them."""
    fields = max_bits + 2
    edges = [round(64 * i / fields) for i in range(fields + 1)]
    masks = []
    for one, two in combinations(range(fields), 2):
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in (one, two))
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    nodes: Column = F.array(
        *[
            F.struct(F.lit(i).alias("mask"), F.col("bits").bitwiseAND(F.lit(m)).alias("pattern"))
            for i, m in enumerate(masks)
        ]
    )
    placed = bits.select("bits", F.explode(nodes).alias("node")).select("node.*", "bits")
    shared = (
        placed.groupBy("mask", "pattern")
        .count()
        .where("count > 1")
        .select("mask", "pattern", F.ceil(F.col("count") / node_size).cast("int").alias("parts"))
    )
    part = F.pmod(F.xxhash64("bits", "pattern"), "parts").cast("int")
    other = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: i != F.col("part"))
    )
    cut = (
        placed.join(shared, ["mask", "pattern"])
        .withColumn("part", part)
        .withColumn("other", F.explode(other))
        .select(
            "mask",
            "pattern",
            F.least("part", "other").alias("low"),
            F.greatest("part", "other").alias("high"),
            "bits",
        )
    )
    key = ["mask", "pattern", "low", "high"]
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(group: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((gray_rank(own), group))
        group, own = group[order], own[order]
        label = linked(group, own, max_bits)
        moved = np.flatnonzero(label != np.arange(len(label)))
        signed = own.view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(signed[moved]), pa.array(signed[label[moved]])], schema=schema
        )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for part in parts:
            if not part.num_rows:
                continue
            rows = np.stack([part.column(i).to_numpy(zero_copy_only=False) for i in range(5)])
            held = [np.concatenate([*held, rows], axis=1)] if held else [rows]
            rows = held[0]
            new = np.r_[True, (rows[:4, 1:] != rows[:4, :-1]).any(axis=0)]
            tail = np.flatnonzero(new)[-1]  # the last node may go on in the next batch
            if tail:
                group = np.cumsum(new)[:tail]
                yield search(group, rows[4, :tail].astype(np.int64).view(np.uint64))
                held = [rows[:, tail:]]
        if held:
            own = held[0][4].astype(np.int64).view(np.uint64)
            yield search(np.zeros(len(own), np.int64), own)

    dealt = cut.select(*[F.col(c).cast("long").alias(c) for c in (*key, "bits")])
    return (
        dealt.repartition(*key)
        .sortWithinPartitions(*key)
        .mapInArrow(run, "a long, b long")
        .distinct()
    )


# -- components ----------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that links (a, b) reach from it, for every node that
    occurs in a link. Rounds of large-star and small-star. The minimum of each node is folded before it
    meets in one task, and written before the links are joined with it: both sides of the join are then
    plain shuffles, and adaptive execution splits a node that many links share."""

    def stars(pairs: DataFrame, larger: bool) -> DataFrame:
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        back = pairs.select(F.col("b").alias("u"), F.col("a").alias("v"))
        ends = both.unionByName(back)
        if not larger:
            ends = ends.where("v < u")
        low = ends.groupBy("u").agg(F.min("v").alias("low"))
        low = materialize(low.withColumn("low", F.least("u", "low")), "low")
        joined = ends.join(low, "u")
        if larger:
            moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("low").alias("b"))
        else:
            moved = joined.where("v != low").select(F.col("v").alias("a"), F.col("low").alias("b"))
            moved = moved.unionByName(low.select(F.col("u").alias("a"), F.col("low").alias("b")))
        return moved.where("a != b").distinct()

    def state(pairs: DataFrame) -> tuple:
        mark = F.xxhash64("a", "b").cast("decimal(38,0)")
        return tuple(pairs.agg(F.count("*"), F.sum(mark)).first())

    edges = materialize(edges.where("a != b"), "links")
    before = state(edges)
    while before[0]:
        edges = materialize(stars(stars(edges, larger=True), larger=False), "links")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, doc_id="doc_id", text="text",
    key: Column | None = None,
) -> DataFrame:
    """doc_id, ``key``, ``bits``, ``root`` (a fingerprint that names the component) and
    ``component_id``, the smallest doc_id linked to it in any number of steps; one row per row of
    ``docs``."""
    found = materialize(fingerprints(docs, shingle, doc_id, text, key), "fingerprints")
    smallest = found.groupBy("bits").agg(F.min("doc_id").alias("doc_id"))
    roots = components(links(smallest.select("bits"), max_bits))
    rooted = smallest.join(roots, smallest.bits == roots.node, "left").select(
        "bits", F.coalesce("root", "bits").alias("root"), "doc_id"
    )
    # Written, as in ``components``, so that a root with many fingerprints can be split.
    lowest = materialize(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "lowest")
    named = rooted.join(lowest, "root").select("bits", "root", "component_id")
    return found.join(named, "bits").select("doc_id", "key", "bits", "root", "component_id")


def digest(duplicates: DataFrame) -> DataFrame:
    return duplicates.select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )
