"""Quality rules with cross-document line frequency.

Each text gets its counts and the hashes of its distinct normalised lines (A-Z in lower case, white
space collapsed). For each host and line the distinct documents are counted; a line in more than
``line_limit`` of them is removed, and a document that keeps less than ``min_left`` of its words is
depleted and rejected, as is one that fails the base rules.

Documents are distinct if their normalised texts differ: whole copies count as one, so a text copied a
thousand times is left to near-duplicate removal. Documents that differ anywhere each count, however
much of a template they share, so a page that is little more than its host's template is depleted.

Shuffles: line hashes are folded by (host, line, document) and counted from there, so a line in a third
of all documents is folded before its count meets in one task. The frequent lines are written, so the
join of lines with them is one of two plain sides: broadcast where they are few, and split by adaptive
execution where a line is hot. What is removed is gathered by a number that each row got when it was
measured, so repeated rows do not meet. Texts are read once and not shuffled.

Defined cases: a null text has no word and fails the base rules, as does an empty one. A null host
counts as the empty host. Repeated rows count as one document and each get the result. An empty table
gives an empty result. Very long texts are measured whole, one at a time. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailwake.llm.common import ascii_lower, row_key
from tailwake.sources.workspace import materialize

LINE_LIMIT = 10
MIN_LEFT = 0.2
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\v\f\r"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

LINE = pa.list_(pa.struct([("hash", pa.string()), ("words", pa.int64())]))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
PASSED = ("number", "doc_id", "key", "host")
SCHEMA = pa.schema(
    [("number", pa.int64()), ("doc_id", pa.int64()), ("key", pa.string()), ("host", pa.string())]
    + [(c, pa.int64()) for c in COUNTS]
    + [("content", pa.string()), ("lines", LINE)]
)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three that occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.array([codes.setdefault(w, len(codes)) for w in words], np.int64)
    pairs = ids[:-1] * len(codes) + ids[1:]
    if len(codes) > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, where, seen = np.unique(pairs[:-1] * len(codes) + ids[2:], return_inverse=True, return_counts=True)
    again = seen[where] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


def measure_text(text: str | None) -> tuple[list[int], str, list[dict]]:
    """Counts, hash of the normalised text, and hash and words of its distinct lines."""
    text = text or ""
    words = text.encode().split()
    seen, repeated, lines, content = set(), 0, {}, md5()
    for line in text.split("\n"):
        normal = b" ".join(line.encode().lower().split())
        if not normal:
            continue
        repeated += line in seen
        seen.add(line)
        content.update(normal + b"\n")
        count = normal.count(b" ") + 1
        lines[normal] = lines.get(normal, 0) + count
    counts = [
        len(words),
        len(text) - sum(map(text.count, SPACE)),
        sum(map(text.count, SYMBOLS)),
        repeated,
        repeat_words(words),
    ]
    return counts, content.hexdigest(), [{"hash": md5(k).hexdigest()[:16], "words": n} for k, n in lines.items()]


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """Counts and line hashes of each row, with a number of its own, a key that names it by what it
    holds, and the hash of its normalised text. To be written before it is used twice."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [measure_text(t.as_py()) for t in part.column("text")]
            counts = np.array([c for c, _, _ in found], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in PASSED),
                    *(pa.array(counts[:, i]) for i in range(len(COUNTS))),
                    pa.array([content for _, content, _ in found], pa.string()),
                    pa.array([lines for _, _, lines in found], LINE),
                ],
                schema=SCHEMA,
            )

    chosen = docs.select(
        F.monotonically_increasing_id().alias("number"),
        F.col("doc_id").cast("long").alias("doc_id"),
        row_key(F.col("doc_id"), F.col("text")).alias("key"),
        F.coalesce(F.col(host), F.lit("")).alias("host"),
        F.col("text").alias("text"),
    )
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return chosen.mapInArrow(
        run,
        f"number long, doc_id long, key string, host string, {counts}, content string, "
        "lines array<struct<hash:string,words:long>>",
    )


def frequent_lines(measured: DataFrame, line_limit: int = LINE_LIMIT) -> DataFrame:
    """(host, hash) of the lines that more than ``line_limit`` distinct documents of a host hold."""
    lines = measured.select("host", F.explode("lines.hash").alias("hash"), "content").distinct()
    return lines.groupBy("host", "hash").count().where(F.col("count") > line_limit).select("host", "hash")


def removed_lines(measured: DataFrame, line_limit: int = LINE_LIMIT) -> DataFrame:
    """For each row with lines above the limit: number, ``removed`` hashes, ``removed_words``."""
    frequent = materialize(frequent_lines(measured, line_limit), "frequent")
    lines = measured.select("number", "host", F.explode("lines").alias("line")).select(
        "number", "host", "line.hash", "line.words"
    )
    return (
        lines.join(frequent, ["host", "hash"])
        .groupBy("number")
        .agg(F.collect_list("hash").alias("removed"), F.sum("words").alias("removed_words"))
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def judge_documents(
    docs: DataFrame, host: str = "source", line_limit: int = LINE_LIMIT, min_left: float = MIN_LEFT
) -> DataFrame:
    """One row per row of ``docs``: doc_id, key, the counts, base_failed, kept, and the hashes and
    number of words of its removed lines."""
    measured = materialize(measure(docs, host), "measured")
    removed = removed_lines(measured, line_limit)
    joined = measured.join(removed, "number", "left")
    words = F.coalesce("removed_words", F.lit(0))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    depleted = F.col("n_words") - words < F.lit(min_left) * F.col("n_words")
    return joined.select(
        "doc_id",
        "key",
        "host",
        *COUNTS,
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        words.alias("removed_words"),
        F.coalesce("removed", F.array().cast("array<string>")).alias("removed"),
    )


def without_lines(text: Column, removed: Column) -> Column:
    """``text`` without the lines whose hash is in ``removed``."""

    def digest(line: Column) -> Column:
        normal = F.regexp_replace(ascii_lower(line), r"[\x20\x09-\x0D]+", " ")
        return F.substring(F.md5(F.trim(normal).cast("binary")), 1, 16)

    kept = F.filter(F.split(text, "\n", -1), lambda line: ~F.array_contains(removed, digest(line)))
    return F.when(F.size(removed) == 0, text).otherwise(F.array_join(kept, "\n"))


def digest(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", "removed_words")
