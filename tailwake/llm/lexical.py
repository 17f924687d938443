"""Ranked lexical search by pipelined term partitioning.

Items (queries) travel as bundles through a line of stages. Each stage owns a part of the terms; it
adds the contributions of its terms to the sparse accumulators that the bundle carries, a score for
each document met so far, and hands the bundle on. After the last stage the best documents of each
accumulator are chosen. Contributions are integers, so neither the order of the stages nor that of the
additions matters.

The grid: documents are dealt by hash of their row to shards of about ``SHARD_POSTINGS`` postings, items
to blocks of about ``BLOCK_ITEMS``. A stage is a cogroup, on (block, shard), of the bundles with the
postings that the stage owns, so a term in every document is spread over all shards, and a group holds
one shard's postings and its bundles whatever the size of the input. Accumulators are packed, a bit a
document and eight bytes a score above zero, and unpacked one item at a time.

Only terms of items have postings: the counts of a document's terms meet the vocabulary of the items in
an equality join. Spark broadcasts the vocabulary where it is small by its own limit and otherwise
shuffles both sides, where a hot term is split as any skewed key. A document's number of terms travels
as the count of one of ``MARKS`` further terms, so that no key holds a row for each document.

Defined cases: a null text has no term, and a document without one takes no part, nor does an item
without any term that a document holds. Rows with the same item_id and text are one item; other texts
under the same id are ranked on their own. Repeated documents each count and each can be found. A null
doc_id is ranked after all others of equal score. Empty tables give an empty result. Texts count whole,
however long. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tailwake.sources.workspace import materialize

TOP = 10
OWNERS = 3
BLOCK_ITEMS = 256
SHARD_POSTINGS = 1 << 18
#: A document counts as so many postings when shards are sized.
DOCUMENT_SHARE = 8
MARKS = 64
MARK = -1  # number of all marks
FLUSH = 1 << 18

_TERMS = bytes(
    c if c > 127 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32
    for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of digits, letters and code points above U+007F, A-Z in lower case, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


# --- counts ---


def term_counts(rows: DataFrame, key: str) -> DataFrame:
    """One row for each row of ``rows`` and distinct term: place (names the row), key, size (all its
    terms), term and tf; and for each row with a term one with a mark as the term and size as tf."""
    schema = pa.schema(
        [("place", pa.int64()), ("key", pa.int64()), ("size", pa.int64()), ("term", pa.string()), ("tf", pa.int64())]
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows, sizes, widths, terms, counts = [], [], [], [], []

            def made() -> pa.RecordBatch:
                at = pa.array(np.repeat(np.array(rows, np.int64), widths))  # noqa: B023
                return pa.RecordBatch.from_arrays(
                    [
                        part.column("place").take(at),  # noqa: B023
                        part.column("key").take(at),  # noqa: B023
                        pa.array(np.repeat(np.array(sizes, np.int64), widths)),  # noqa: B023
                        pa.array(terms, pa.binary()).cast(pa.string()),  # noqa: B023
                        pa.array(counts, pa.int64()),  # noqa: B023
                    ],
                    schema=schema,
                )

            for row, text in enumerate(part.column("text")):
                found = Counter(terms_of(text.as_py()))
                if found:
                    rows.append(row)
                    sizes.append(found.total())
                    widths.append(len(found) + 1)
                    terms += [b" %d" % (row % MARKS), *found]
                    counts += [sizes[-1], *found.values()]
                if len(terms) > FLUSH:
                    yield made()
                    rows, sizes, widths, terms, counts = [], [], [], [], []
            yield made()

    placed = rows.select(
        F.monotonically_increasing_id().alias("place"),
        F.col(key).cast("long").alias("key"),
        F.col("text").alias("text"),
    )
    return placed.mapInArrow(run, "place long, key long, size long, term string, tf long")


def number_terms(asked: DataFrame) -> DataFrame:
    """term and number of the terms of items and of the marks, written once so that numbers stay."""
    spark = asked.sparkSession
    terms = asked.where(~F.col("term").startswith(" ")).select("term").distinct()
    marks = spark.range(MARKS).select(F.concat(F.lit(" "), F.col("id").cast("string")).alias("term"))
    numbered = terms.withColumn("number", F.monotonically_increasing_id())
    return materialize(numbered.unionAll(marks.withColumn("number", F.lit(MARK).cast("long"))), "terms")


# --- accumulators ---


def pack(scores: np.ndarray) -> tuple[bytes, bytes]:
    """Which scores are above zero, a bit each, and these scores. Their bytes are laid out by place,
    the upper ones being mostly zero and so easy to compress."""
    seen = scores > 0
    return np.packbits(seen).tobytes(), scores[seen].view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(seen: bytes | None, values: bytes | None, n: int) -> np.ndarray:
    scores = np.zeros(n, np.int64)
    if values:
        at = np.unpackbits(np.frombuffer(seen, np.uint8), count=n).view(bool)
        scores[at] = np.frombuffer(values, np.uint8).reshape(8, -1).T.copy().view(np.int64)[:, 0]
    return scores


BUNDLE = pa.schema(
    [
        ("block", pa.int64()), ("shard", pa.int64()), ("item", pa.int64()), ("item_key", pa.int64()),
        ("numbers", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
        ("seen", pa.binary()), ("scores", pa.binary()),
    ]
)
BUNDLE_DDL = (
    "block long, shard long, item long, item_key long, numbers array<long>, times array<long>, "
    "seen binary, scores binary"
)
#: The row of a group that carries its documents: their places as numbers, their keys as times.
DOCUMENTS = -1


class Shard:
    """A group at a stage: the documents of the shard, and its postings by term."""

    def __init__(self, bundles: pa.Table, postings: pa.Table):
        self.items = bundles.to_pylist()
        known = next((row for row in self.items if row["item"] == DOCUMENTS), None)
        numbers = postings["number"].to_numpy()
        if known is None:  # the first stage: its postings bring the documents
            marks = postings.filter(pa.array(numbers == MARK)).sort_by("place")
            known = {"item": DOCUMENTS, "numbers": marks["place"].to_pylist(), "times": marks["key"].to_pylist()}
        else:
            self.items.remove(known)
        self.documents = known
        self.places = np.array(known["numbers"], np.int64)
        order = np.argsort(numbers, kind="stable")
        self.at = np.searchsorted(self.places, postings["place"].to_numpy()[order])
        self.impact = postings["impact"].to_numpy()[order]
        numbers, starts = np.unique(numbers[order], return_index=True)
        ends = np.r_[starts, len(order)][1:]
        self.slices = {n: slice(s, e) for n, s, e in zip(numbers.tolist(), starts, ends, strict=True) if n != MARK}

    def accumulators(self) -> Iterator[tuple[dict, np.ndarray | None]]:
        """Each bundle with its scores after this stage; none if the stage has nothing to add."""
        for row in self.items:
            owned = [(self.slices[n], t) for n, t in zip(row["numbers"], row["times"], strict=True) if n in self.slices]
            if not owned:
                yield row, None
                continue
            scores = unpack(row["seen"], row["scores"], len(self.places))
            for some, times in owned:  # a document occurs once in the postings of a term
                scores[self.at[some]] += times * self.impact[some]
            yield row, scores


def carry_on(key: tuple, bundles: pa.Table, postings: pa.Table) -> pa.Table:
    """A stage: bundles with the contributions of its terms."""
    group = Shard(bundles, postings)
    named = {"block": key[0].as_py(), "shard": key[1].as_py()}
    out = [{**group.documents, **named}]
    for row, scores in group.accumulators():
        if scores is not None:
            row["seen"], row["scores"] = pack(scores)
        out.append(row)
    return pa.Table.from_pylist(out, BUNDLE)


FOUND = pa.schema([("item", pa.int64()), ("item_key", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def finish(top: int):
    """The last stage: the best documents of each bundle in this shard."""

    def run(key: tuple, bundles: pa.Table, postings: pa.Table) -> pa.Table:
        group = Shard(bundles, postings)
        keys = pa.array(group.documents["times"], pa.int64())
        absent = keys.is_null().to_numpy(zero_copy_only=False)
        ids = keys.fill_null(0).to_numpy()
        out = []
        for row, scores in group.accumulators():
            if scores is None:
                scores = unpack(row["seen"], row["scores"], len(group.places))
            at = np.flatnonzero(scores)
            if len(at) > top:
                at = at[scores[at] >= np.partition(scores[at], -top)[-top]]
            at = at[np.lexsort((ids[at], absent[at], -scores[at]))][:top]
            out += [
                {"item": row["item"], "item_key": row["item_key"], "doc_id": None if absent[i] else int(ids[i]),
                 "score": int(scores[i])}
                for i in at
            ]
        return pa.Table.from_pylist(out, FOUND)

    return run


# --- search ---


def numbers(n: int) -> Column:
    """0 to n - 1."""
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, owners: int = OWNERS, item: str = "item_id"
) -> DataFrame:
    """The ``top`` highest-scoring documents of each item: item id, rank, doc_id, score."""
    spark = docs.sparkSession
    asked = materialize(term_counts(items.select(item, "text").distinct(), item), "items")
    terms = number_terms(asked)
    postings = materialize(
        term_counts(docs, "doc_id").join(terms, "term").select("place", "key", "size", "number", "tf"), "postings"
    )
    counts = materialize(
        postings.groupBy("number").agg(F.count("*").alias("df"), F.sum("tf").alias("total")), "counts"
    )
    marks = counts.where(F.col("number") == MARK).first()
    n, size = (marks["df"], marks["total"]) if marks else (0, 1)
    sums = counts.where(F.col("number") != MARK).agg(F.sum("df")).first()[0] or 0
    blocks = -(-asked.where(F.col("term").startswith(" ")).count() // BLOCK_ITEMS) or 1
    shards = -(-(sums + DOCUMENT_SHARE * n) // SHARD_POSTINGS) or 1

    # Terms that documents hold, with their weights, in the blocks of the items that ask for them.
    weight = F.floor(1000 * F.log((2 * F.lit(n) + 2) / (2 * F.col("df") + 1)))
    weights = counts.where(F.col("number") != MARK).select("number", weight.alias("weight"))
    block = F.pmod(F.xxhash64("place"), F.lit(blocks))
    wanted = asked.join(terms, "term").join(weights, "number").withColumn("block", block)
    bundles = (
        wanted.groupBy("block", F.col("place").alias("item"))
        .agg(F.max("key").alias("item_key"), F.collect_list(F.struct("number", "tf")).alias("terms"))
        .withColumn("shard", F.explode(numbers(shards)))
        .select(
            "block", "shard", "item", "item_key", F.col("terms.number").alias("numbers"),
            F.col("terms.tf").alias("times"), F.lit(None).cast("binary").alias("seen"),
            F.lit(None).cast("binary").alias("scores"),
        )
    )
    places = materialize(wanted.select("number", "weight", "block").distinct(), "wanted")

    shard = F.pmod(F.xxhash64("place"), F.lit(shards))
    length = F.expr(f"100 - 75 + (75 * size * {n}L) div {size}L")
    impact = F.expr("weight * ((1000000000L * tf) div (1000 * tf + 8 * length))")
    dealt = postings.withColumns({"shard": shard, "length": length})
    marked = dealt.where(F.col("number") == MARK).select(
        F.explode(numbers(blocks)).alias("block"),
        "shard", "place", "key", "number", F.lit(0).cast("long").alias("impact"),
    )

    group = ["block", "shard"]
    for owner in range(owners):
        own = places.where(F.pmod("number", F.lit(owners)) == owner)
        added = (
            dealt.join(own, "number")
            .withColumn("impact", impact)
            .where(F.col("impact") > 0)
            .select(*group, "place", F.lit(None).cast("long").alias("key"), "number", "impact")
        )
        if owner == 0:
            added = added.unionAll(marked.select(*added.columns))
        last = owner == owners - 1
        bundles = (
            bundles.groupBy(*group)
            .cogroup(added.groupBy(*group))
            .applyInArrow(
                finish(top) if last else carry_on,
                "item long, item_key long, doc_id long, score long" if last else BUNDLE_DDL,
            )
        )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = bundles.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.col("item_key").alias(item), "rank", "doc_id", "score")
