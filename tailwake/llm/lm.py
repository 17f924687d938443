"""Language-model scores from an Elias-Fano n-gram trie.

The model has ``len(strengths) + 1`` orders, three by default. A word's own probability comes from the
counts of the training documents; each higher order smooths its counts towards the order below:

    p(w) = (c(w) + 1) / (N + V + 1)
    p(w | h) = (c(h, w) + S * p(w | h')) / (c(h) + S)      h': h without its first word
    p(w | h) = b(h) * p(w | h'),  b(h) = S / (c(h) + S)    where (h, w) was never seen

Each level of the trie holds what was seen: a node's smoothed probability and its weight as a context,
one byte each (``PROBABILITIES``, ``WEIGHTS``). What a higher level builds on are these quantised values,
so that the stored model is exactly what is asked. A text's score is the sum of log10 p over its words and
one end. Its history begins with one end; where that is shorter than h, the lower order counts.

The model grows with the corpus, so it is never in one place. Documents are read once, into batches that
are written to the shared folder: lists of word numbers, with the hashes of their words. The levels are
built one after another. A batch asks for each of its distinct words (by hash), then pairs, then triples
once, and sends with each question how often its training documents hold it. From the second level on
a context and a word are named by the numbers of their nodes, so only words depend on hashes, of
64 bits; what has an unseen part is not asked. An answer also says if no other batch asked: where that
holds for the context of a sequence, or for the sequence without its first word, no other batch can hold
the sequence, and the batch works out that part of the level by the same formula. Other questions go to shards: words by hash, others by their
context. A context that was seen more than ``SPREAD`` times is dealt by its words to one more shard for
each ``SPREAD``; the batch knows its count from the level below. A shard adds up the counts, works out
probabilities, writes its part of the level to a file, maps it into memory, answers and removes the
file. A batch meets its answers to ask for the next level, and in the end for the sums.

The number of shards follows the number of tokens (``SHARD_TOKENS``), and each shard is a partition of its
own number. Of any word or sequence a shard gets at most one question a batch. Questions and answers are
sorted lists in binary, a few bytes each.

Defined cases: a null or empty text is the end alone. A null doc_id counts as the empty text for the
split. Repeated rows are scored, and learned from, each. An empty table gives an empty result. Without
training documents all counts are zero. A very long text is one batch. Only doc_id and text are read.
"""

from __future__ import annotations

import pickle
import struct
import tempfile
import zlib
from collections.abc import Iterator, Sequence
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailwake.llm.common import remainder, words_of
from tailwake.llm.eliasfano import EliasFano, Trie
from tailwake.sources.workspace import materialize

HELD_OUT, FOLDS = 2, 7
#: Weight of the order below, in occurrences of the context, for pairs, triples and so on.
STRENGTHS = (200.0, 10.0)
END = b"\n"  # no word holds white space
BATCH_TOKENS = 1_000_000
BATCH_DOCS = 2048
SHARD_TOKENS = 4_000_000
LEAST_SHARDS = 12
#: Occurrences of a context for each further shard that its followers go to.
SPREAD = 1 << 17
EXACT, STEP = 96, 1.15
#: Count that a code of a context's weight stands for: itself, then the middle of a step.
WEIGHTS = np.r_[np.arange(EXACT + 1), EXACT * STEP ** (np.arange(255 - EXACT) + 0.5)]
#: Codes 1 to 255 of a probability: steps of a twentieth in log10, from 1 down. Code 0: never seen.
STEPS = 20
PROBABILITIES = np.r_[0.0, 10.0 ** (-np.arange(255) / STEPS)]

BATCH_SQL = "batch long, tokens long, body binary"
ROW_SQL = "place int, batch long, keys binary, counts binary"
ANSWER_SQL = "batch long, level int, place int, body binary, total long, distinct long"
SCORES = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64())]
    + [("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)
SCORES_SQL = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def encode_counts(counts: np.ndarray) -> np.ndarray:
    """One-byte code of each count."""
    steps = np.log(np.maximum(counts, 1) / EXACT) / np.log(STEP)
    high = np.minimum(EXACT + 1 + np.floor(np.maximum(steps, 0)), 255)
    return np.where(counts <= EXACT, counts, high).astype(np.uint8)


def encode_probabilities(values: np.ndarray) -> np.ndarray:
    """One-byte code of each probability above 0."""
    return np.clip(np.rint(-STEPS * np.log10(values)) + 1, 1, 255).astype(np.uint8)


def smoothed(count: np.ndarray, below: np.ndarray, weight: np.ndarray, strength: float) -> np.ndarray:
    """Codes of the probabilities of what was seen, from its counts, the codes of the suffixes and the
    weights of the contexts."""
    return encode_probabilities(
        np.minimum(1, (count + strength * PROBABILITIES[below]) / (WEIGHTS[weight] + strength))
    )


def _squeeze(values: np.ndarray) -> bytes:
    return zlib.compress(values.tobytes(), 1)


def _unsqueeze(body: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(body), kind)


def _heads(key: np.ndarray) -> np.ndarray:
    """Where each distinct value of a sorted list begins."""
    return np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)


def ordered(keys: np.ndarray) -> np.ndarray:
    """Places of the keys in rising order, equal ones as they come. Key and place are sorted as one
    number where they fit, which is several times faster."""
    bits = len(keys).bit_length()
    if not len(keys) or int(keys.max()) >> (62 - bits):
        return np.argsort(keys, kind="stable")
    packed = np.sort(keys.astype(np.int64) << bits | np.arange(len(keys)))
    return packed & ((1 << bits) - 1)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, where each is first, and the place of each key among them."""
    order = ordered(keys)
    rising = keys[order]
    heads = _heads(rising)
    flags = np.zeros(len(keys), np.int64)
    flags[heads[1:]] = 1
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(flags)
    return rising[heads], order[heads], inverse


PAIRS = struct.Struct("<QQ")


def pack_pairs(left: np.ndarray, right: np.ndarray) -> bytes:
    """Pairs in rising order of (left, right): the distinct numbers of either side, then each pair as
    a number made of two places among them."""
    lefts, _, left = distinct(left)
    rights, _, right = distinct(right)
    parts = [EliasFano.of(values).to_bytes() for values in (lefts, rights, left * len(rights) + right)]
    return PAIRS.pack(len(parts[0]), len(parts[1])) + b"".join(parts)


def unpack_pairs(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct numbers of either side, and the places of each pair's two among them."""
    first, second = PAIRS.unpack(body[: PAIRS.size])
    cuts = np.cumsum([PAIRS.size, first, second])
    parts = (body[cuts[0] : cuts[1]], body[cuts[1] : cuts[2]], body[cuts[2] :])
    lefts, rights, pairs = (EliasFano.from_buffer(part).all() for part in parts)
    return lefts, rights, *(x.astype(np.int64) for x in np.divmod(pairs, np.uint64(max(1, len(rights)))))


def numbered(packed: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """For each list of pairs its rising keys, the place of the left among all lefts above that of the
    right; the places of the left among the lefts of the list; and the bits of a right."""
    lists = [unpack_pairs(body) for body in packed]
    lefts, rights = (np.sort(np.concatenate([x[side] for x in lists])) for side in (0, 1))
    lefts, rights = lefts[_heads(lefts)], rights[_heads(rights)]
    bits = len(rights).bit_length()
    keys = [
        (np.searchsorted(lefts, a)[left] << bits | np.searchsorted(rights, b)[right]).astype(np.uint64)
        for a, b, left, right in lists
    ]
    return keys, [x[2] for x in lists], bits


class _Numbers(dict):
    """Numbers its keys in the order in which they are asked for."""

    def __missing__(self, key: bytes) -> int:
        self[key] = number = len(self)
        return number


class Level:
    """The distinct sequences of one order in a batch. ``left``: place of the context a level below;
    ``right``: place of the word; ``suffix``: place, a level below, of the sequence without its first word;
    ``of``: place of the sequence that ends at each token, -1 where the text's history is too short."""

    def __init__(self, left: np.ndarray, right: np.ndarray, suffix: np.ndarray, of: np.ndarray):
        self.left, self.right, self.suffix, self.of = left, right, suffix, of


class Batch:
    """The distinct words (by hash, rising) of some documents, and where each of their tokens is among
    them."""

    def __init__(self, ids: list, held: np.ndarray, sizes: np.ndarray, tokens: np.ndarray, names: np.ndarray):
        self.ids, self.held, self.sizes, self.tokens, self.names = ids, held, sizes, tokens, names
        self._levels: dict[int, Level] = {}
        self._taught: dict[int, np.ndarray] = {}

    @classmethod
    def of(cls, docs: list[tuple[int | None, bool, list[bytes]]]) -> Batch:
        known = _Numbers({END: 0})
        flat: list[int] = []
        for _, _, words in docs:
            flat.extend(map(known.__getitem__, words))
            flat.append(0)
        hashed = np.fromiter((xxhash.xxh64_intdigest(w) for w in known), np.uint64, len(known))
        names, place = np.unique(hashed, return_inverse=True)
        held = np.array([d[1] for d in docs], bool)
        sizes = np.array([len(d[2]) + 1 for d in docs], np.int64)
        return cls([d[0] for d in docs], held, sizes, place[np.array(flat, np.int64)], names)

    def to_bytes(self) -> bytes:
        # Numbers by falling frequency, a byte of all tokens at a time: the upper bytes are mostly zero.
        order = np.argsort(-np.bincount(self.tokens, minlength=len(self.names)), kind="stable")
        rank = np.empty(len(order), "<u4")
        rank[order] = np.arange(len(order))
        planes = [_squeeze(part) for part in rank[self.tokens].view(np.uint8).reshape(-1, 4).T]
        names = EliasFano.of(self.names).to_bytes()
        return pickle.dumps((self.ids, self.held, self.sizes, planes, _squeeze(order.astype("<u4")), names))

    @classmethod
    def from_bytes(cls, body: bytes) -> Batch:
        ids, held, sizes, planes, order, names = pickle.loads(body)
        ranks = np.stack([_unsqueeze(part, np.uint8) for part in planes], axis=1).view("<u4").ravel()
        tokens = _unsqueeze(order, "<u4").astype(np.int64)[ranks]
        return cls(ids, held, sizes, tokens, EliasFano.from_buffer(names).all())

    @cached_property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    @cached_property
    def taught_rows(self) -> np.ndarray:
        return np.repeat(~self.held, self.sizes)

    def level(self, order: int) -> Level:
        """The sequences of ``order`` words, from 2."""
        if order not in self._levels:
            below = self.tokens if order == 2 else self.level(order - 1).of
            if order == 2:
                # Every text begins after an end, as the token before its first is the last one's end.
                end = int(np.searchsorted(self.names, np.uint64(xxhash.xxh64_intdigest(END))))
                before = np.r_[end, self.tokens[:-1]]
            else:
                before = np.r_[-1, below[:-1]]
                before[self.starts] = -1
            rows = np.flatnonzero(before >= 0)
            width = max(1, len(self.names))
            keys, first, inverse = distinct(before[rows] * width + self.tokens[rows])
            of = np.full(len(self.tokens), -1, np.int64)
            of[rows] = inverse
            self._levels[order] = Level(keys // width, keys % width, below[rows[first]], of)
        return self._levels[order]

    def taught(self, order: int) -> np.ndarray:
        """How often the training documents hold each sequence."""
        if order not in self._taught:
            of = self.tokens if order == 1 else self.level(order).of
            n = len(self.names) if order == 1 else len(self.level(order).left)
            # What is not counted goes to a place before the first.
            places = np.where(self.taught_rows, of + 1, 0)
            self._taught[order] = np.bincount(places, minlength=n + 1)[1:]
        return self._taught[order]


class Model:
    """What all tasks share: the number of shards, the strengths, how far contexts are spread, and the
    totals of the training documents."""

    def __init__(
        self, shards: int, strengths: Sequence[float], spread: int = SPREAD, total: int = 0, distinct: int = 0
    ):
        self.shards, self.strengths, self.spread = shards, tuple(strengths), spread
        self.total, self.distinct = total, distinct

    def alone(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1) / (self.total + self.distinct + 1)


class Known:
    """What a batch knows of its sequences of one order: the code of the smoothed probability (0: never
    seen), the probability, the code of the weight as a context, the node (-1: none), and whether no other
    batch holds the sequence."""

    def __init__(
        self, code: np.ndarray, p: np.ndarray, weight: np.ndarray, node: np.ndarray, own: np.ndarray
    ):
        self.code, self.p, self.weight, self.node, self.own = code, p, weight, node, own


class Dialogue:
    """A batch and the answers that it has got so far, by (level, shard)."""

    def __init__(self, batch: Batch, answers: dict[tuple[int, int], bytes], model: Model):
        self.batch, self.answers, self.model = batch, answers, model
        self._known: dict[int, Known] = {}

    def _places(self, order: int) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, which) of what is asked at a level, by shard and there in the order of its keys."""
        if order == 1:
            yield from _by_shard((self.batch.names % np.uint64(self.model.shards)).astype(np.int64))
            return
        level, below, words = self.batch.level(order), self.known(order - 1), self.known(1)
        which = np.flatnonzero(self._seen(order) & ~self._own(order))
        rank = _ranks(below.node)[level.left[which]] * len(words.node) + _ranks(words.node)[level.right[which]]
        which = which[ordered(rank)]
        left, right = below.node[level.left[which]], words.node[level.right[which]]
        parts = np.ceil(np.maximum(WEIGHTS[below.weight[level.left[which]]], 1) / self.model.spread).astype(np.uint64)
        shard = (_mix(left) + _mix(right) % parts * np.uint64(0x9E3779B1)) % np.uint64(self.model.shards)
        for place, rows in _by_shard(shard.astype(np.int64)):
            yield place, which[rows]

    def _seen(self, order: int) -> np.ndarray:
        """Sequences all of whose parts were seen."""
        level, below, words = self.batch.level(order), self.known(order - 1), self.known(1)
        return (below.node[level.left] >= 0) & (below.node[level.suffix] >= 0) & (words.node[level.right] >= 0)

    def _own(self, order: int) -> np.ndarray:
        """Sequences whose context, or suffix, no other batch holds."""
        level, below = self.batch.level(order), self.known(order - 1)
        return below.own[level.left] | below.own[level.suffix]

    def questions(self, order: int) -> Iterator[tuple[int, bytes, bytes]]:
        """(shard, keys, counts) of each question. From the second level on, what probabilities are worked
        out from comes with the counts: the code of each suffix and the weight of each context."""
        taught = self.batch.taught(order)
        for shard, which in self._places(order):
            counts = _squeeze(taught[which].astype("<u4"))
            if order == 1:
                yield shard, EliasFano.of(self.batch.names[which]).to_bytes(), counts
                continue
            level, below, words = self.batch.level(order), self.known(order - 1), self.known(1)
            left, right = below.node[level.left[which]], words.node[level.right[which]]
            contexts = which[np.flatnonzero(np.r_[True, left[1:] != left[:-1]])]
            codes, weights = below.code[level.suffix[which]], below.weight[level.left[contexts]]
            yield shard, pack_pairs(left, right), pickle.dumps((counts, _squeeze(codes), _squeeze(weights)))

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word the count in the training documents, the node, and whether no other batch holds it."""
        counts = np.zeros(len(self.batch.names), np.int64)
        node = np.full(len(counts), -1, np.int64)
        own = np.zeros(len(counts), bool)
        for shard, which in self._places(1):
            raw, places, alone = pickle.loads(self.answers[1, shard])
            counts[which] = _unsqueeze(raw, "<u8").astype(np.int64)
            found = which[counts[which] > 0]
            node[found] = EliasFano.from_buffer(places).all().astype(np.int64) * self.model.shards + shard
            own[found] = _bits(alone, len(found))
        return counts, node, own

    def known(self, order: int) -> Known:
        if order not in self._known:
            self._known[order] = self._first() if order == 1 else self._above(order)
        return self._known[order]

    def _first(self) -> Known:
        counts, node, own = self.words
        code = encode_probabilities(self.model.alone(counts))
        return Known(np.where(counts > 0, code, 0), PROBABILITIES[code], encode_counts(counts), node, own)

    def _above(self, order: int) -> Known:
        level, below = self.batch.level(order), self.known(order - 1)
        strength = self.model.strengths[order - 2]
        code, weight = np.zeros((2, len(level.left)), np.uint8)
        node = np.full(len(level.left), -1, np.int64)
        alone = np.zeros(len(level.left), bool)
        for shard, which in self._places(order):
            codes, weights, places, flags = pickle.loads(self.answers[order, shard])
            code[which] = _unsqueeze(codes, np.uint8)
            found = which[code[which] > 0]
            weight[found] = _unsqueeze(weights, np.uint8)
            node[found] = EliasFano.from_buffer(places).all().astype(np.int64) * self.model.shards + shard
            alone[found] = _bits(flags, len(found))
        # The batch's own part of the level. Its nodes need no number: what they begin is the batch's own too.
        taught = self.batch.taught(order)
        own = np.flatnonzero(self._seen(order) & self._own(order) & (taught > 0))
        code[own] = smoothed(
            taught[own], below.code[level.suffix[own]], below.weight[level.left[own]], strength
        )
        weight[own], node[own], alone[own] = encode_counts(taught[own]), 0, True
        back_off = strength / (WEIGHTS[below.weight[level.left]] + strength)
        p = np.where(code > 0, PROBABILITIES[code], back_off * below.p[level.suffix])
        return Known(code, p, weight, node, alone)

    def scores(self) -> pa.Table:
        batch, model = self.batch, self.model
        counts, _, _ = self.words
        alone = model.alone(counts)
        p = np.log10(alone)[batch.tokens]
        base = p.copy()
        for order in range(2, len(model.strengths) + 2):
            of = batch.level(order).of
            rows = np.flatnonzero(of >= 0)
            p[rows] = np.log10(self.known(order).p)[of[rows]]

        def per_document(values: np.ndarray) -> pa.Array:
            return pa.array(np.add.reduceat(values, batch.starts))

        return pa.table(
            [
                pa.array(batch.ids, pa.int64()),
                pa.array(batch.held),
                pa.array(batch.sizes),
                per_document((counts[batch.tokens] > 0).astype(np.int64)),
                pa.array(np.full(len(batch.ids), model.total)),
                per_document(base),
                per_document(p),
            ],
            schema=SCORES,
        )


def _ranks(node: np.ndarray) -> np.ndarray:
    out = np.empty(len(node), np.int64)
    out[np.argsort(node)] = np.arange(len(node))
    return out


def _bits(body: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(body, np.uint8), count=n).astype(bool)


def _mix(values: np.ndarray) -> np.ndarray:
    return (values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for which in np.split(order, cuts) if len(order) else []:
        yield int(shard[which[0]]), which


def _batches(parts: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, Batch]]:
    task = TaskContext.get()
    number, held, size = (task.partitionId() if task else 0) << 32, [], 0
    for part in parts:
        rows = zip(part.column("doc_id"), part.column("held_out"), part.column("text"), strict=True)
        for doc_id, held_out, text in rows:
            words = words_of(text.as_py())
            held.append((doc_id.as_py(), held_out.as_py(), words))
            size += len(words) + 1
            if size >= BATCH_TOKENS or len(held) >= most:
                yield number, Batch.of(held)
                number, held, size = number + 1, [], 0
    if held:
        yield number, Batch.of(held)


def _folded(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted keys the distinct ones that training documents hold, their counts, where each is first, and
    whether a single batch asked for it."""
    heads = _heads(key)
    if not len(heads):
        return key, count, heads, np.empty(0, bool)
    sums, askers = np.add.reduceat(count, heads), np.diff(np.r_[heads, len(key)])
    kept = sums > 0
    return key[heads[kept]], sums[kept], heads[kept], askers[kept] == 1


def answer_words(named: list[bytes], counts: list[bytes]) -> tuple[list[bytes], int, int]:
    """For each question of one shard the exact counts, and of what was seen the nodes and whether one batch
    alone asked; tokens and words in all."""
    asked = [EliasFano.from_buffer(body).all() for body in named]
    given = [_unsqueeze(body, "<u4") for body in counts]
    key, count = np.concatenate(asked), np.concatenate(given).astype(np.int64)
    order = np.argsort(key, kind="stable")  # hashes fill all 64 bits
    key, count, _, alone = _folded(key[order], count[order])
    replies = []
    with tempfile.TemporaryDirectory() as folder:
        path = Path(folder) / "level"
        path.write_bytes(EliasFano.of(key).to_bytes())
        level = EliasFano.from_buffer(np.asarray(np.memmap(path, np.uint8, mode="r")))
        for own in asked:
            place = level.successor(own)
            found = place < level.count
            found[found] = level.get(place[found]) == own[found]
            out = np.zeros(len(own), "<u8")
            out[found] = count[place[found]]
            place = place[found]
            parts = (_squeeze(out), EliasFano.of(place).to_bytes(), np.packbits(alone[place]).tobytes())
            replies.append(pickle.dumps(parts))
        del level
    return replies, int(count.sum()), len(key)


def answer_sequences(named: list[bytes], rest: list[bytes], strength: float) -> tuple[list[bytes], int, int]:
    """For each question of one shard the codes of probabilities, and of what was seen the weights, the
    nodes and whether one batch alone asked. The shard's part of the level is a trie in a file of the task."""
    asked, lefts, bits = numbered(named)
    counts, codes, weights = [], [], []
    for left, body in zip(lefts, rest, strict=True):
        count, code, weight = pickle.loads(body)
        counts.append(_unsqueeze(count, "<u4"))
        codes.append(_unsqueeze(code, np.uint8))
        weights.append(_unsqueeze(weight, np.uint8)[left])
    key, count, code, weight = map(np.concatenate, (asked, counts, codes, weights))
    order = ordered(key)
    key, count, heads, alone = _folded(key[order], count[order].astype(np.int64))
    code, weight = code[order[heads]], weight[order[heads]]
    replies = []
    with tempfile.TemporaryDirectory() as folder:
        path = Path(folder) / "level"
        Trie.write(path, key, smoothed(count, code, weight, strength), bits, encode_counts(count))
        trie = Trie.open(path)
        for own in asked:
            place = trie.places(own)
            found = place[place >= 0]
            out = np.zeros(len(own), np.uint8)
            out[place >= 0] = trie.codes[found]
            flags = np.packbits(alone[found]).tobytes()
            places = EliasFano.of(found).to_bytes()
            replies.append(pickle.dumps((_squeeze(out), _squeeze(trie.weights[found]), places, flags)))
        del trie
    return replies, int(count.sum()), len(key)


def _answer(table: pa.Table, order: int, strength: float) -> pa.Table:
    named, counts = table.column("keys").to_pylist(), table.column("counts").to_pylist()
    if order == 1:
        replies, total, distinct = answer_words(named, counts)
    else:
        replies, total, distinct = answer_sequences(named, counts, strength)
    n, shard = len(replies), table.column("place")[0].as_py()
    return pa.table(
        [
            table.column("batch").combine_chunks(),
            pa.array([order] * n, pa.int32()),
            pa.array([shard] * n, pa.int32()),
            pa.array(replies, pa.binary()),
            pa.array([total, *[0] * (n - 1)], pa.int64()),
            pa.array([distinct, *[0] * (n - 1)], pa.int64()),
        ],
        names=["batch", "level", "place", "body", "total", "distinct"],
    )


def _met(table: pa.Table, model: Model) -> tuple[int, Dialogue]:
    """A batch and its answers, from the rows of one group."""
    own, answers = None, {}
    rows = zip(*(table.column(c).to_pylist() for c in ("level", "place", "body")), strict=True)
    for level, place, body in rows:
        if level == 0:
            own = Batch.from_bytes(body)
        else:
            answers[level, place] = body
    return table.column("batch")[0].as_py(), Dialogue(own, answers, model)


def score_documents(
    docs: DataFrame,
    strengths: Sequence[float] = STRENGTHS,
    batch_docs: int = BATCH_DOCS,
    shard_tokens: int = SHARD_TOKENS,
    spread: int = SPREAD,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (words
    alone) and score (the model), both log10 probabilities. The model has an order more than
    ``strengths``; the other parameters bound batches and shards and do not change results."""
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        F.col("text").alias("text"),
    )

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in _batches(parts, batch_docs):
            row = ([number], [len(batch.tokens)], [batch.to_bytes()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(row, (pa.int64(), pa.int64(), pa.binary()), strict=True)],
                names=["batch", "tokens", "body"],
            )

    batches = materialize(chosen.mapInArrow(read, BATCH_SQL), "batches")
    tokens = batches.agg(F.sum("tokens")).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-tokens // shard_tokens))
    model = Model(shards, strengths, spread)
    meeting = batches.select("batch", F.lit(0).alias("level"), F.lit(0).alias("place"), "body")

    for order in range(1, len(model.strengths) + 2):
        answered = materialize(_level(meeting, model, order), f"level{order}")
        if order == 1:
            seen = answered.agg(F.sum("total"), F.sum("distinct")).first()
            model = Model(shards, strengths, spread, int(seen[0] or 0), int(seen[1] or 0))
        meeting = meeting.unionByName(answered.select(*meeting.columns))

    def finish(table: pa.Table) -> pa.Table:
        return _met(table, model)[1].scores()

    return meeting.groupBy("batch").applyInArrow(finish, SCORES_SQL)


def _level(meeting: DataFrame, model: Model, order: int) -> DataFrame:
    """Answers of one level to all batches, which know the levels below."""
    strength = model.strengths[order - 2] if order > 1 else 0.0

    def ask(table: pa.Table) -> pa.Table:
        number, dialogue = _met(table, model)
        rows = [(shard, number, keys, counts) for shard, keys, counts in dialogue.questions(order)]
        columns = zip(*rows, strict=True) if rows else ([], [], [], [])
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            names=["place", "batch", "keys", "counts"],
        )

    def answer(table: pa.Table) -> pa.Table:
        return _answer(table, order, strength)

    def ask_first(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in range(len(part)):
                yield from ask(pa.Table.from_batches([part.slice(row, 1)])).to_batches()

    if order == 1:  # a batch alone, without answers
        asked = meeting.mapInArrow(ask_first, ROW_SQL)
    else:
        asked = meeting.groupBy("batch").applyInArrow(ask, ROW_SQL)
    dealt = asked.repartitionById(model.shards, F.col("place"))
    return dealt.groupBy("place").applyInArrow(answer, ANSWER_SQL)
