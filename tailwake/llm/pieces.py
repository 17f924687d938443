"""SentencePiece encoding and decoding with unigram scores.

Pieces sit in a double-array trie over their UTF-8 bytes: the child of state s by byte c is
base[s] + c, if check there names s. The Viterbi search keeps, for each position, the best sum of
scores of the pieces up to it; it runs over many stretches of text at a time, one position after the
other, all of them taking a step in the trie together. A character that no piece covers costs less
than any piece is worth and is written as its bytes. Of equal sums the longer last piece stays.

White space becomes the marker, with one marker before the text, and decoding takes both back. No
piece has a marker after another character, so a text is cut before each run of markers and each
distinct stretch is searched once and remembered.

Vocabulary and scores come from the model file and are never trained; the trie is built on the driver
and has the size of the vocabulary. Scores are used as log scores whatever the file was made for.

Defined cases: null and empty texts have no ids and decode to the empty text. The marker character
itself counts as a space, so a text that holds it decodes to one with spaces. Repeated rows are
encoded each; an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: How much less than the worst piece an unknown character is worth.
UNKNOWN_PENALTY = 10.0
CHUNK = 256
REMEMBERED = 500_000
#: Bytes of stretches that are searched together.
LANE_BYTES = 4_000_000


class DoubleArray:
    """A trie over byte strings: ``base``, ``check`` and ``value`` (-1: no entry ends here)."""

    def __init__(self, entries: dict[bytes, int]):
        children: dict[bytes, set[int]] = {}
        for entry in entries:
            for i in range(len(entry)):
                children.setdefault(entry[:i], set()).add(entry[i])
        size = 4 * sum(map(len, children.values())) + 1024
        base, check, value, taken = [0] * size, [-1] * size, [-1] * size, bytearray(size)
        taken[0] = 1
        first, edge, queue = 256, 256, [(b"", 0)]  # an only child always fits in the first gap
        for prefix, state in queue:
            steps = sorted(children.get(prefix, ()))
            if not steps:
                continue
            first = taken.index(0, first)
            # An only child fills the first gap; others go where all of them fit, near the edge.
            at = max(first - steps[0], 1 if len(steps) == 1 else edge - 256, 1)
            while any(taken[at + c] for c in steps):
                at += 1
            base[state], edge = at, max(edge, at)
            for c in steps:
                entry = prefix + bytes([c])
                taken[at + c], check[at + c], value[at + c] = 1, state, entries.get(entry, -1)
                queue.append((entry, at + c))
        size = edge + 512
        base, check, value = (np.array(a[:size], np.int32) for a in (base, check, value))
        self.base, self.check, self.value = base, check, value


class Pieces:
    """A vocabulary: pieces as bytes with a space for the marker, scores, trie, byte pieces."""

    def __init__(self, pieces: list[tuple[str, float, str]], prefix: bool = True):
        """``pieces``: (piece, score, kind) by id; kinds are normal, byte, control and unknown."""
        self.prefix = prefix
        self.scores = np.array([s for _, s, _ in pieces], np.float64)
        normal = {p.replace(MARK, " ").encode(): i for i, (p, _, k) in enumerate(pieces) if k == "normal"}
        if any(b" " in piece.lstrip(b" ") for piece in normal):
            raise ValueError("a piece holds a marker after another character")
        self.byte_ids = np.zeros(256, np.uint32)
        self.out: list[bytes] = []
        for i, (piece, _, kind) in enumerate(pieces):
            if kind == "byte":
                self.byte_ids[int(piece[3:5], 16)] = i
                self.out.append(bytes([int(piece[3:5], 16)]))
            else:
                self.out.append(piece.replace(MARK, " ").encode() if kind == "normal" else b"")
        self.is_byte = np.array([k == "byte" for _, _, k in pieces], bool)
        self.unknown = float(min(self.scores[list(normal.values())])) - UNKNOWN_PENALTY
        self.trie = DoubleArray(normal)
        alone = not any(b"\n" in p and len(p) > 1 for p in normal)
        self.stretch = re.compile(r" *[^ \n]+| +|\n" if alone else r" *[^ ]+| +")
        self.known: dict[str, bytes] = {}

    @classmethod
    @cache
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)

        def kind(i: int) -> str:
            if model.is_byte(i):
                return "byte"
            return "unknown" if model.is_unknown(i) else "control" if model.is_control(i) else "normal"

        count = model.get_piece_size()
        return cls([(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(count)])

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    # -- search ----------------------------------------------------------------------------------

    def search(self, stretches: list[bytes]) -> list[np.ndarray]:
        """The best ids of each stretch."""
        order = sorted(range(len(stretches)), key=lambda i: len(stretches[i]))
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(stretches)
        while order:  # lanes of like length, longest first, within a bound of bytes
            longest = max(1, len(stretches[order[-1]]))
            lanes = max(1, min(len(order), LANE_BYTES // (longest + 1)))
            chosen, order = order[-lanes:], order[:-lanes]
            for i, ids in zip(chosen, self._lanes([stretches[i] for i in chosen]), strict=True):
                out[i] = ids
        return out

    def _lanes(self, stretches: list[bytes]) -> list[np.ndarray]:
        sizes = np.array([len(s) for s in stretches], np.int64)
        n, width = len(stretches), int(sizes.max(initial=0))
        text = np.zeros((n, width + 1), np.uint8)
        text[np.arange(width + 1) < sizes[:, None]] = np.frombuffer(b"".join(stretches), np.uint8)
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        start = np.zeros((n, width + 1), np.int32)  # where the last piece begins
        piece = np.full((n, width + 1), -1, np.int32)
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        for at in range(width):
            lane = np.flatnonzero((best[:, at] > -np.inf) & (at < sizes))
            if not len(lane):
                continue
            lead = text[lane, at]
            char = at + 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0).astype(np.int64)
            single = np.zeros(n, bool)
            reach, state, stop = lane, np.zeros(len(lane), np.int64), at
            until = np.zeros(n, np.int64)
            until[lane] = char
            while len(reach):
                inside = stop < sizes[reach]
                reach, state = reach[inside], state[inside]
                if not len(reach):
                    break
                following = base[state].astype(np.int64) + text[reach, stop]
                goes = (check[following] == state) & (base[state] > 0)
                reach, state = reach[goes], following[goes]
                stop += 1
                found = value[state]
                ends = found >= 0
                hit, ids = reach[ends], found[ends]
                single[hit[until[hit] == stop]] = True
                total = best[hit, at] + self.scores[ids]
                better = total > best[hit, stop]
                hit = hit[better]
                best[hit, stop], start[hit, stop], piece[hit, stop] = total[better], at, ids[better]
            bare = ~single[lane]
            lone, stop_at = lane[bare], np.minimum(char[bare], sizes[lane[bare]])
            total = best[lone, at] + self.unknown
            better = total > best[lone, stop_at]
            lone, stop_at = lone[better], stop_at[better]
            best[lone, stop_at], start[lone, stop_at], piece[lone, stop_at] = total[better], at, -1
        # Back from the ends, one piece of every lane at a time.
        place, steps = sizes.copy(), []
        active = np.flatnonzero(place > 0)
        while len(active):
            end, begin = place[active], start[active, place[active]]
            steps.append((active, begin, end, piece[active, end]))
            place[active] = begin
            active = active[begin > 0]
        found: list[list[int]] = [[] for _ in range(n)]
        for lanes, begins, ends, ids in reversed(steps):
            for lane, begin, end, i in zip(
                lanes.tolist(), begins.tolist(), ends.tolist(), ids.tolist(), strict=True
            ):
                if i >= 0:
                    found[lane].append(i)
                else:
                    found[lane] += self.byte_ids[text[lane, begin:end]].tolist()
        return [np.array(f, "<u4") for f in found]

    # -- texts -----------------------------------------------------------------------------------

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        texts = list(texts)
        for at in range(0, len(texts), CHUNK):
            cut = []
            for text in texts[at : at + CHUNK]:
                text = (text or "").replace(MARK, " ")
                cut.append(self.stretch.findall(" " + text if self.prefix and text else text))
            if len(self.known) > REMEMBERED:
                self.known.clear()
            new = [s for s in set().union(*cut) if s not in self.known]
            for s, ids in zip(new, self.search([s.encode() for s in new]), strict=True):
                self.known[s] = ids.tobytes()
            for stretches in cut:
                yield b"".join(map(self.known.__getitem__, stretches))

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.out.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        if self.prefix and text.startswith(b" "):
            text = text[1:]
        return text.decode("utf-8", "replace")


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit), n_bytes (ids of single bytes), decoded text, and
    whether it is the text again; ``model`` is a model file on the driver."""
    pieces = Pieces.load(model)
    shared = docs.sparkSession.sparkContext.broadcast(pieces)  # of the vocabulary's size
    kind = pa.struct([("ids", pa.binary()), ("n_bytes", pa.int64()), ("decoded", pa.string())])

    @F.arrow_udf("struct<ids:binary,n_bytes:bigint,decoded:string>")
    def run(texts: pa.Array) -> pa.Array:
        own = shared.value
        rows = []
        for ids in own.encode(t.as_py() for t in texts):
            count = int(own.is_byte[np.frombuffer(ids, "<u4")].sum())
            rows.append({"ids": ids, "n_bytes": count, "decoded": own.decode(ids)})
        return pa.array(rows, kind)

    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(
        F.col("doc_id").alias("doc_id"), text.alias("text"), run(text).alias("found")
    )
    return found.select(
        "doc_id",
        "found.*",
        (F.col("found.decoded") == F.replace("text", F.lit(MARK), F.lit(" "))).alias("round_trip"),
    )


def digest(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        "n_bytes",
        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
        "round_trip",
    )
