"""Spelling variants by Bloom-guided neighbourhoods.

Words are counted over all documents; two words are near if one inserted, deleted or replaced code
point turns one into the other. Every word generates its edits as hashes only (a polynomial hash, so
each edit takes a few operations whatever the length of the word) and probes them against blocked
Bloom filters, one for each word length. Edits that the filters let through become strings and are
joined with the vocabulary, which removes the false positives; all others go nowhere. Half of the
edits are enough, since being near works both ways: replacements by a higher code point, and
deletions, each of which stands for the insertion on the other side.

Memory: the filters are built by a grouped bit-or, a row for each block of 512 bits and 32 words. A
broadcast holds at most ``WAVE_BLOCKS`` blocks (64 MB). A larger vocabulary takes several waves, each
with its range of blocks: an edit belongs to one block and so to one wave, and no neighbour is lost.
Words of ``LONGEST`` code points or more share a filter. Edits are generated in chunks of bounded size.

Skew: documents are counted where they are read and the counts folded before the shuffle, so neither
a hot source nor a frequent word meets in one task. A word of length l has at most some 180 l
neighbours. Chains of forms are shortened by doubling, both sides written first, so that adaptive
execution can split a form that many words lead to.

Defined cases: a null text has no words; a null doc_id counts as the empty text where words are named
by it. Repeated rows count each time. Of near words with equal counts the smallest in code-point order
is the form. An empty table gives an empty result. Words longer than any other of the table have
no neighbours and cost no probe. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailwake.sources.workspace import materialize

MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
#: Of the runs of a document, one in so many loses a code point, chosen by a hash of both.
DROP_EVERY = 97
#: Letters that make up runs; code points above U+00FF end them.
LETTERS = bytes([*range(65, 91), *range(97, 123), *range(0xC0, 0x100)])
LONGEST = 255
WORDS_A_BLOCK = 32
WAVE_BLOCKS = 1 << 20
WORDS_A_TASK = 16384
FLUSH_WORDS, FLUSH_BYTES = 200_000, 16 << 20
CHUNK = 1 << 20

_ASCII_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_RUNS = bytes(_ASCII_LOWER[c] if c in LETTERS else 32 for c in range(256))


# --- words and their counts ---


def runs(text: str | None) -> list[bytes]:
    """Maximal runs of letters, A-Z in lower case, in Latin-1: one byte is one code point."""
    return (text or "").encode("latin-1", "replace").translate(_RUNS).split()


def dropped(run: bytes, seed: int, drop_every: int) -> bytes:
    """``run``, or for one hash in ``drop_every`` the run without one code point. ``seed`` is the
    crc32 of what names the document."""
    named = run if run.isascii() else run.decode("latin-1").encode()
    code = zlib.crc32(named, seed)
    if code % drop_every:
        return run
    place = code % len(run)
    return run[:place] + run[place + 1 :]


def vocabulary(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    drop_every: int | None = DROP_EVERY,
) -> DataFrame:
    """Distinct words of at least ``min_length`` code points and ``min_count`` occurrences: word, n.
    Without ``drop_every`` runs are words as they stand."""

    def batch(counts: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = Counter(), 0
        for part in parts:
            for doc_id, text in zip(part.column("doc_id"), part.column("text"), strict=True):
                seed = zlib.crc32(f"{doc_id.as_py()}:".encode())
                for word, n in Counter(runs(text.as_py())).items():
                    if drop_every:
                        word = dropped(word, seed, drop_every)
                    if len(word) >= min_length:
                        held += 0 if word in counts else len(word)
                        counts[word] += n
                if len(counts) > FLUSH_WORDS or held > FLUSH_BYTES:
                    yield batch(counts)
                    counts, held = Counter(), 0
        yield batch(counts)

    chosen = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").alias("text")
    )
    counted = chosen.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


# --- hashes of words and edits ---

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(codes: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        codes = (codes ^ (codes >> np.uint64(shift))) * np.uint64(factor)
    return codes ^ (codes >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    """The base to the power of 0 to n."""
    return np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE)], dtype=np.uint64)


def _prefixes(letters: np.ndarray) -> np.ndarray:
    """Hash of the first 0, 1, ... code points of each word, one word a row."""
    out = np.zeros((len(letters), letters.shape[1] + 1), np.uint64)
    for place in range(letters.shape[1]):
        out[:, place + 1] = out[:, place] * _BASE + letters[:, place]
    return out


class Layout:
    """Which blocks hold the words of which length; ``counts`` has at most ``LONGEST`` entries."""

    def __init__(self, counts: dict[int, int]):
        self.words = counts
        self.blocks = {k: -(-n // WORDS_A_BLOCK) for k, n in sorted(counts.items())}
        ends = np.cumsum([0, *self.blocks.values()])
        self.first = dict(zip(self.blocks, ends.tolist(), strict=False))
        self.total = int(ends[-1])

    def place(self, codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Block of each hash of a word of that length, and the 48 bits that choose a bit in each of
        the eight 64-bit words of the block."""
        mixed = _mix(codes)
        kind = min(length, LONGEST)
        block = ((mixed >> np.uint64(32)) * np.uint64(self.blocks[kind])) >> np.uint64(32)
        return block.astype(np.int64) + self.first[kind], _mix(mixed + _BASE)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and code points, one word a row, of the words of each length, in bounded chunks."""
    coded = [w.encode("latin-1") for w in words]
    lengths = np.array([len(w) for w in coded])
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        step = max(1, CHUNK // length)
        for start in range(0, len(rows), step):
            some = rows[start : start + step]
            joined = b"".join(coded[i] for i in some)
            yield some, np.frombuffer(joined, np.uint8).reshape(len(some), length)


# --- filters ---


def _kind(word):
    return F.least(F.length(word), F.lit(LONGEST))


def letters_by_length(words: DataFrame) -> dict[int, np.ndarray]:
    """Code points that words of each length are made of: at most 90 for each length."""
    used = words.select(_kind("word").alias("kind"), F.explode(F.split("word", "")).alias("letter"))
    found: dict[int, list[int]] = {}
    for kind, letter in used.where("letter <> ''").distinct().collect():
        found.setdefault(kind, []).append(ord(letter))
    return {kind: np.array(sorted(codes), np.uint64) for kind, codes in found.items()}


def filter_blocks(words: DataFrame, plan: Layout) -> DataFrame:
    """The blocked Bloom filters: a row for each block, with its eight 64-bit words."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for _, letters in _by_length(part.column("word").to_pylist()):
                block, bits = plan.place(_prefixes(letters)[:, -1], letters.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block), pa.array(bits.view(np.int64))], ["block", "bits"]
                )

    placed = words.select("word").mapInArrow(run, "block long, bits long")
    return placed.groupBy("block").agg(
        *[F.expr(f"bit_or(shiftleft(1L, int(shiftright(bits, {6 * i}) & 63)))").alias(f"w{i}") for i in range(8)]
    )


def load_wave(blocks: DataFrame, low: int, high: int) -> np.ndarray:
    """Blocks ``low`` to ``high`` as an array of at most ``WAVE_BLOCKS`` rows of eight words."""
    table = blocks.where((F.col("block") >= low) & (F.col("block") < high)).toArrow()
    out = np.zeros((high - low, 8), np.uint64)
    at = table["block"].to_numpy() - low
    for i in range(8):
        out[at, i] = table[f"w{i}"].to_numpy().view(np.uint64)
    return out


def probe(filters: np.ndarray, low: int, block: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places of the hashes whose eight bits are all set in blocks from ``low``; word by word, so
    most are out after the first."""
    left = np.flatnonzero((block >= low) & (block < low + len(filters)))
    for i in range(8):
        shift = (bits[left] >> np.uint64(6 * i)) & np.uint64(63)
        left = left[(filters[block[left] - low, i] >> shift) & np.uint64(1) == 1]
    return left


# --- neighbours ---


def _replacements(letters, prefixes, powers, alphabet, plan, filters, low):
    """Words with one code point replaced by a higher one, as far as the filters hold them."""
    length = letters.shape[1]
    whole = prefixes[:, -1]
    for place in range(length):
        own = letters[:, place].astype(np.uint64)
        word, other = np.nonzero(alphabet[None, :] > own[:, None])
        codes = whole[word] + (alphabet[other] - own[word]) * powers[length - 1 - place]
        kept = probe(filters, low, *plan.place(codes, length))
        if len(kept):
            made = letters[word[kept]]
            made[:, place] = alphabet[other[kept]]
            yield word[kept], made


def _deletions(letters, prefixes, powers, plan, filters, low):
    """Words with one code point less, as far as the filters hold them; of equal neighbours only the
    first is deleted."""
    length = letters.shape[1]
    whole = prefixes[:, -1]
    for place in range(length):
        rest = powers[length - 1 - place]
        codes = whole - prefixes[:, place + 1] * rest + prefixes[:, place] * rest
        kept = probe(filters, low, *plan.place(codes, length - 1))
        if place:
            kept = kept[letters[kept, place] != letters[kept, place - 1]]
        if len(kept):
            yield kept, np.delete(letters[kept], place, axis=1)


def near_candidates(words: DataFrame, plan: Layout, alphabets: dict, filters, low: int) -> DataFrame:
    """Edits of each word that the filters of a wave let through: word, n, near. ``filters`` is a
    broadcast array."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            words, counts = part.column("word").to_pylist(), part.column("n").to_numpy()
            for rows, letters in _by_length(words):
                length = letters.shape[1]
                found = []
                prefixes, powers = _prefixes(letters), _powers(length)
                kind = min(length, LONGEST)
                if plan.words[kind] > 1:
                    found.append(
                        _replacements(letters, prefixes, powers, alphabets[kind], plan, filters.value, low)
                    )
                if min(length - 1, LONGEST) in plan.blocks:
                    found.append(_deletions(letters, prefixes, powers, plan, filters.value, low))
                for edits in found:
                    for at, made in edits:
                        size, text = made.shape[1], made.tobytes().decode("latin-1")
                        near = [text[i : i + size] for i in range(0, len(text), size)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([words[i] for i in rows[at]], pa.string()),
                                pa.array(counts[rows[at]]),
                                pa.array(near, pa.string()),
                            ],
                            ["word", "n", "near"],
                        )

    return words.mapInArrow(run, "word string, n long, near string")


def near_words(words: DataFrame, wave_blocks: int | None = None) -> DataFrame:
    """Both directions of all pairs of near words of a vocabulary (word, n): word, near, near_n."""
    spark = words.sparkSession
    wave_blocks = wave_blocks or WAVE_BLOCKS
    plan = Layout(dict(map(tuple, words.groupBy(_kind("word")).count().collect())))
    alphabets = letters_by_length(words)
    blocks = materialize(filter_blocks(words, plan), "filters")
    dealt = words.repartition(-(-sum(plan.words.values()) // WORDS_A_TASK) or 1, "word")
    waves = []
    for low in range(0, plan.total, wave_blocks):
        high = min(low + wave_blocks, plan.total)
        filters = spark.sparkContext.broadcast(load_wave(blocks, low, high))
        waves.append(materialize(near_candidates(dealt, plan, alphabets, filters, low), "candidates"))
        filters.unpersist()
    if not waves:
        return words.select("word", F.col("word").alias("near"), F.col("n").alias("near_n"))  # no row
    candidates = reduce(DataFrame.unionAll, waves)
    exact = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = candidates.join(exact, "near")
    both = F.array(
        F.struct(F.col("word"), F.col("near"), F.col("near_n")),
        F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    return pairs.select(F.explode(both).alias("pair")).select("pair.*")


# --- forms and roots ---


def forms(words: DataFrame, near: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form and form_n: the near word of largest n, if that is ``ratio`` times n."""
    nothing = F.lit(None)
    own = words.select("word", "n", nothing.cast("string").alias("near"), nothing.cast("long").alias("near_n"))
    links = near.select("word", nothing.cast("long").alias("n"), "near", "near_n")
    first = F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near"))
    grouped = own.unionAll(links).groupBy("word").agg(
        F.max("n").alias("n"), F.count("near").alias("n_near"), F.min(first).alias("best")
    )
    follows = -F.col("best.less") >= ratio * F.col("n")
    return grouped.select(
        "word",
        "n",
        "n_near",
        F.when(follows, F.col("best.near")).alias("form"),
        F.when(follows, -F.col("best.less")).alias("form_n"),
    )


def add_roots(found: DataFrame) -> DataFrame:
    """``forms`` with ``root``, the end of the chain of forms. Counts at least double along a chain,
    so it has no cycle and a few rounds of doubling reach its end."""
    hops = materialize(found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("to")), "hops")
    while True:
        ahead = hops.select(F.col("word").alias("to"), F.col("to").alias("further"))
        moved = F.col("further").isNotNull()
        hops = materialize(
            hops.join(ahead, "to", "left").select(
                "word", F.coalesce("further", "to").alias("to"), moved.alias("moved")
            ),
            "hops",
        )
        if hops.where("moved").isEmpty():
            break
        hops = hops.select("word", "to")
    ends = hops.select("word", F.col("to").alias("root"))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    drop_every: int | None = DROP_EVERY,
) -> DataFrame:
    """One row for each word of the vocabulary: word, n, n_near, form, form_n, root."""
    words = materialize(vocabulary(docs, min_length, min_count, drop_every), "vocabulary")
    return add_roots(materialize(forms(words, near_words(words), ratio), "forms"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("word", "form", "root", "n", "n_near", "form_n")
