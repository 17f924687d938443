import math
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest
import xxhash

from tailwake.llm import lm
from tailwake.llm.eliasfano import EliasFano, Trie


@pytest.mark.parametrize(
    "count, top",
    [(0, 9), (1, 1), (1, 2**63), (5, 3), (1000, 2**20), (1000, 2**48), (5000, 5000), (300, 2**64 - 1)],
)
def test_sequences(count, top):
    rng = np.random.default_rng(count)
    values = np.sort(rng.integers(0, top, count, dtype=np.uint64, endpoint=True))
    sequence = EliasFano.from_buffer(EliasFano.of(values).to_bytes())
    assert (sequence.all() == values).all()
    asked = np.concatenate([rng.integers(0, top, 300, dtype=np.uint64, endpoint=True), values])
    assert (sequence.successor(asked) == np.searchsorted(values, asked)).all()
    if count:
        places = rng.integers(0, count, 200)
        assert (sequence.get(places) == values[places]).all()
    if count >= 1000:
        bits = 8 * len(sequence.to_bytes()) / count
        assert bits < 4.5 + max(0, math.log2(top / count))


def test_trie_finds_pairs(tmp_path):
    rng = np.random.default_rng(7)
    keys = np.unique(rng.integers(0, 300, 5000, dtype=np.uint64) << np.uint64(24) | rng.integers(0, 900, 5000, dtype=np.uint64))
    codes = rng.integers(1, 255, len(keys)).astype(np.uint8)
    Trie.write(tmp_path / "trie", keys, codes)
    asked = np.concatenate([keys, rng.integers(0, 400 << 24, 3000, dtype=np.uint64)])
    known = dict(zip(keys.tolist(), codes.tolist(), strict=True))
    found = Trie.open(tmp_path / "trie").find(asked)
    assert found.tolist() == [known.get(k, 0) for k in asked.tolist()]
    Trie.write(tmp_path / "none", keys[:0], codes[:0])
    assert not Trie.open(tmp_path / "none").find(asked).any()


def test_codes_are_exact_then_close():
    counts = np.array([0, 1, 5, lm.EXACT, lm.EXACT + 1, 1000, 10**6, 10**11])
    back = lm.WEIGHTS[lm.encode_counts(counts)]
    assert (back[:4] == counts[:4]).all()
    assert (np.abs(back[4:] / counts[4:] - 1) < lm.STEP**0.5 - 1 + 1e-9).all()


def tokens_of(text):
    return (text or "").encode().lower().split() + [b"\n"]


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7


def code_of(p):
    return min(255, max(1, round(-lm.STEPS * math.log10(p)) + 1))


def brute(rows, strengths=lm.STRENGTHS):
    """The model from plain dictionaries; what is stored is quantised, level by level."""
    seen = Counter()
    for doc_id, text in rows:
        if fold(doc_id) != 2:
            own = [b"\n", *tokens_of(text)]
            for end in range(1, len(own)):
                for order in range(1, min(len(strengths) + 1, end + 1) + 1):
                    seen[tuple(own[end + 1 - order : end + 1])] += 1
    words = {gram[0]: n for gram, n in seen.items() if len(gram) == 1}
    total, distinct = sum(words.values()), len(words)

    def alone(word):
        return (words.get(word, 0) + 1) / (total + distinct + 1)

    def quantised(p):
        return 10 ** (-(code_of(p) - 1) / lm.STEPS)

    def weight(gram):
        return lm.WEIGHTS[int(lm.encode_counts(np.array([seen[gram]]))[0])]

    @cache
    def p(gram):
        if len(gram) == 1:
            return quantised(alone(gram[0]))
        s = strengths[len(gram) - 2]
        below = p(gram[1:])
        if not seen[gram]:
            return s / (weight(gram[:-1]) + s) * below
        return quantised(min(1, (seen[gram] + s * below) / (weight(gram[:-1]) + s)))

    out = []
    for doc_id, text in rows:
        own = [b"\n", *tokens_of(text)]
        ends = range(1, len(own))
        score = 0.0
        for end in ends:
            order = min(len(strengths) + 1, end + 1)
            gram = tuple(own[end + 1 - order : end + 1])
            score += math.log10(p(gram) if order > 1 else alone(gram[0]))
        base = sum(math.log10(alone(w)) for w in own[1:])
        known = sum(words.get(w, 0) > 0 for w in own[1:])
        out.append((doc_id, fold(doc_id) == 2, len(ends), known, total, base, score))
    return out


def agree(found, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for a, b in zip(sorted(map(tuple, found), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9)
        assert math.isclose(a[6], b[6], rel_tol=1e-9)


@pytest.mark.parametrize("strengths", [(), (200.0,), lm.STRENGTHS, (50.0, 20.0, 5.0)])
def test_whole_table_against_brute_force(spark, strengths):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    agree(lm.score_documents(docs, strengths).collect(), brute(rows, strengths))


def test_small_batches_and_split_contexts_give_the_same(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    agree(lm.score_documents(docs, batch_docs=9, shard_tokens=2500, spread=20).collect(), brute(rows))


def test_followers_of_a_hot_context_are_spread():
    rows = [(i, False, [b"x", f"w{i}".encode()]) for i in range(4000)]
    batch = lm.Batch.of(rows)
    model = lm.Model(16, lm.STRENGTHS, spread=100)
    answers = {}
    for shard, keys, counts in lm.Dialogue(batch, {}, model).questions(1):
        # Two batches that ask for the same.
        replies, total, words = lm.answer_words([keys] * 2, [counts] * 2)
        answers[1, shard] = replies[0]
        model.total, model.distinct = model.total + total, model.distinct + words
    sizes = [len(lm.unpack_pairs(keys)[2]) for _, keys, _ in lm.Dialogue(batch, answers, model).questions(2)]
    assert sum(sizes) == 8001 and max(sizes) < 2 * 8001 / 16


def test_orders_beat_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mean = []
    for strengths in ((200.0,), lm.STRENGTHS):
        found = lm.score_documents(docs, strengths).toPandas()
        held = found[found.held_out]
        mean.append((held.score.sum() - held.base_score.sum()) / held.n_tokens.sum())
    assert mean[0] > 0.3 and mean[1] > mean[0] + 0.2


def test_one_exchange_deals_the_questions(spark):
    rows = "batch long, level int, place int, body binary"
    plan = lm._level(spark.createDataFrame([], rows), lm.Model(12, lm.STRENGTHS), 2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 2, text  # batches with their answers, then shards


def test_batches_survive_their_bytes():
    batch = lm.Batch.of([(1, False, [b"a", b"b", b"a"]), (None, True, []), (3, False, [b"b"])])
    again = lm.Batch.from_bytes(batch.to_bytes())
    assert again.ids == [1, None, 3]
    for name in ("held", "sizes", "tokens", "names"):
        assert (getattr(again, name) == getattr(batch, name)).all()


def test_words_that_share_hash_bits_are_apart(spark):
    # Same upper 24 bits, and the same three above the lowest 16.
    seen, found = {}, []
    for i in range(60_000):
        word = f"w{i}"
        value = xxhash.xxh64_intdigest(word.encode())
        found.append((seen.setdefault((value >> 40, value >> 16 & 7), word), word))
    twins = [pair for pair in found if pair[0] != pair[1]]
    assert twins
    taught, asked = twins[0]
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows = [(i, f"x {taught}") for i in range(60) if zlib.crc32(str(i).encode()) % 7 != 2]
    rows += [(held, f"x {asked}")]
    agree(lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect(), brute(rows))


def test_pairs_survive_their_bytes():
    left, right = np.array([3, 3, 10**12]), np.array([5, 10**9, 2])
    lefts, rights, a, b = lm.unpack_pairs(lm.pack_pairs(left, right))
    assert lefts[a].tolist() == left.tolist() and rights[b].tolist() == right.tolist()


def test_contexts_end_with_their_text():
    batch = lm.Batch.of([(1, False, [b"a", b"b"]), (2, False, [b"c"])])
    level = batch.level(3)
    assert (level.of >= 0).tolist() == [False, True, True, False, True]
    assert batch.taught(3).sum() == 3 and batch.taught(2).sum() == 5


def test_odd_rows(spark, odd_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    agree(lm.score_documents(odd_documents).collect(), brute(rows))
    assert lm.score_documents(odd_documents.limit(0)).count() == 0
    empty = spark.createDataFrame([(2, None), (10, "a b")], "doc_id long, text string")
    agree(lm.score_documents(empty).collect(), brute([(2, None), (10, "a b")]))
