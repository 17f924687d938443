"""Packing of token ids into windows by multiway differencing (Karmarkar-Karp).

A document's ids are cut into full windows, each a sequence of its own, and a rest. Rests are packed
BATCH at a time: every rest starts as a partial partition with one filled window; the two partial
partitions with the largest spread are merged, the fullest windows of one with the emptiest of the
other, until one is left. Opposing imbalances cancel, so its windows are nearly equal. The window
count starts at the least possible and rises by one whenever a window exceeds the capacity.

One pass over the input without a shuffle. A task holds one batch of rests; its result depends only
on its rows in their order, so a task that runs again gives the same. Sequence ids hold the number of
the partition in their upper bits.

Defined cases: a null or empty text is the end id alone. Repeated rows are packed each. A null doc_id
stays null. An empty table gives no piece. Only doc_id and text are read.
"""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Iterable, Iterator
from functools import cache
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 4096
END_ID = 2
#: Rests that are packed together.
BATCH = 512
#: Words whose ids a worker remembers.
REMEMBERED = 400_000

SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)

# -- tokens --------------------------------------------------------------------------------------

# How the tokenizer cuts ASCII and Latin-1 letters in lower case.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
#: Words that need no other normalisation than lower case.
_SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]*")
_LETTERS = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß"


class _Known(dict):
    """Words and their ids; a word that is missing is made by ``make`` and kept."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, word: bytes) -> bytes:
        found = self[word] = self.make(word)
        return found


class WordEncoder:
    """Ids of texts, for a byte-level BPE that lowers case, drops white space and never joins across
    it.

    A text's ids are then those of its words in a row, so each distinct word is tokenised once and
    remembered; so are the parts of words. What was used lately outlives the bound of the memory.
    Words of ASCII and Latin-1 letters are cut here and their parts given to the tokenizer's model;
    all others go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        in_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = str.maketrans({c: in_bytes.pre_tokenize_str(c)[0][0] for c in _LETTERS})
        self.words = _Known(self._word)
        self.older: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            if len(self.parts) > REMEMBERED:
                self.parts.clear()
            text = part if part.isascii() else part.translate(self.letters)
            ids = [t.id for t in self.model.tokenize(text)]
            found = self.parts[part] = pack(f"<{len(ids)}I", *ids)
        return found

    def _word(self, word: bytes) -> bytes:
        if word in self.older:
            return self.older[word]
        text = word.decode()
        if _SIMPLE.fullmatch(text) and "<|" not in text:
            return b"".join(map(self._part, _PARTS.findall(text.lower())))
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        for text in texts:
            if len(self.words) > REMEMBERED // 2:
                self.older, self.words = self.words, _Known(self._word)
            yield b"".join(map(self.words.__getitem__, (text or "").encode().split()))


@cache
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


# -- differencing --------------------------------------------------------------------------------


def differencing(sizes: list[int], count: int) -> list[list[int]]:
    """Positions of ``sizes`` in ``count`` windows of nearly equal sums."""
    # A partial partition: its filled windows as (sum, positions), fullest first.
    heap = [(-size, i, [(size, [i])]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        over = len(one) + len(two) - count
        if over > 0:
            # The emptiest filled windows of one meet the emptiest of two in opposite order.
            tail = zip(one[len(one) - over :], reversed(two[len(two) - over :]), strict=True)
            both = [(a[0] + b[0], a[1] + b[1]) for a, b in tail]
            merged = one[: len(one) - over] + two[: len(two) - over] + both
        else:
            merged = one + two
        merged.sort(key=lambda window: -window[0])
        low = merged[-1][0] if len(merged) == count else 0
        heapq.heappush(heap, (low - merged[0][0], serial, merged))
        serial += 1
    return [positions for _, positions in heap[0][2]] if heap else []


def windows(sizes: list[int], capacity: int = WINDOW) -> list[list[int]]:
    """Positions of ``sizes`` (each at most ``capacity``) in as few near-equal windows as fit."""
    count = max(1, -(-sum(sizes) // capacity))
    while True:
        found = differencing(sizes, count)
        if all(sum(sizes[i] for i in w) <= capacity for w in found):
            return found
        count += 1


# -- packing -------------------------------------------------------------------------------------


def pack_rows(
    rows: Iterator[tuple[int | None, bytes]], first_sequence: int, window: int = WINDOW
) -> Iterator[list[tuple]]:
    """Pieces of documents given as (doc_id, ids), a list for each batch."""
    sequence, done, rests = first_sequence, [], []

    def flush() -> list[tuple]:
        nonlocal sequence, done, rests
        for held in windows([len(r[3]) // 4 for r in rests], window) if rests else []:
            offset = 0
            for i in sorted(held):
                doc_id, start, total, ids = rests[i]
                done.append((doc_id, start, len(ids) // 4, ids, total, sequence, offset))
                offset += len(ids) // 4
            sequence += 1
        out, done, rests = done, [], []
        return out

    for doc_id, ids in rows:
        total = len(ids) // 4
        full = total - total % window
        for start in range(0, full, window):
            piece = ids[4 * start : 4 * (start + window)]
            done.append((doc_id, start, window, piece, total, sequence, 0))
            sequence += 1
        if total > full:
            rests.append((doc_id, full, total, ids[4 * full :]))
        if len(rests) == BATCH or len(done) >= BATCH:
            yield flush()
    yield flush()


def pack_documents(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID
) -> DataFrame:
    """Pieces: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id,
    offset. ``tokenizer`` is the path of a tokenizer file on every executor."""
    end = np.array([end_id], "<u4").tobytes()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer)

        def rows() -> Iterator[tuple[int | None, bytes]]:
            for part in parts:
                texts = (t.as_py() for t in part.column("text"))
                ids = part.column("doc_id").to_pylist()
                for doc_id, found in zip(ids, known.encode(texts), strict=True):
                    yield doc_id, found + end

        task = TaskContext.get()
        for pieces in pack_rows(rows(), (task.partitionId() if task else 0) << 40, window):
            if pieces:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*pieces, strict=True), SCHEMA, strict=True)],
                    schema=SCHEMA,
                )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return chosen.mapInArrow(
        run,
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
