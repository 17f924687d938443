import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tailwake.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "İstanbul ſ ẞ <|endoftext|> a<|startoftext|>b it's !'s don't '' '''re x's y\x1cz \x85 q ½ ³a ªº ŒŒ",
    "Σας ΣΑΣ é ́ 日本 \U0001f600 ÀÉß×÷ Straßenbahn l'Été QU'ÎLE we'LL <| <|a|> A\x00B \x7f",
    "",
]


def check_pieces(rows, ids):
    """Every id of every document in exactly one piece, pieces without gaps in their sequence."""
    sequences, parts = {}, {}
    for doc_id, start, length, crc, total, sequence, offset in rows:
        assert total == len(ids[doc_id]) and 0 < length <= packing.WINDOW
        assert crc == zlib.crc32(ids[doc_id][start : start + length].tobytes())
        sequences.setdefault(sequence, []).append((offset, length))
        parts.setdefault(doc_id, []).append((start, length))
    for pieces in (*sequences.values(), *parts.values()):
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
    assert all(sum(n for _, n in parts[d]) == len(i) for d, i in ids.items())
    return len(sequences) * packing.WINDOW / sum(map(len, ids.values())) - 1


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_tokenizer_s(tokenizer, make_text):
    texts = [*ODD, make_text(2, 2000), make_text(3, 50)]
    own = [np.frombuffer(i, "<u4").tolist() for i in packing.encoder(PATH).encode(texts)]
    assert own == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_ids_survive_a_small_memory(tokenizer, make_text, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    texts = [make_text(s, 200) for s in range(5)]
    own = [np.frombuffer(i, "<u4").tolist() for i in packing.WordEncoder(PATH).encode(texts)]
    assert own == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_differencing_balances():
    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes = rng.integers(1, 1500, 300).tolist()
        found = packing.differencing(sizes, 40)
        assert sorted(i for w in found for i in w) == list(range(300))
        sums = [sum(sizes[i] for i in w) for w in found]
        assert len(sums) == 40 and max(sums) - min(sums) < 0.05 * np.mean(sums)


def test_windows_rise_only_when_needed():
    assert len(packing.windows([2000, 2096, 4096])) == 2
    assert len(packing.windows([3000, 3000, 2000])) == 3  # the least, two, can't hold them
    assert packing.windows([]) == []


def test_whole_table(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in packing.digest(packing.pack_documents(docs, PATH)).collect()]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    encoded = tokenizer.encode_batch(list(texts.values()), add_special_tokens=False)
    ids = {d: np.array(e.ids + [2], "<u4") for d, e in zip(texts, encoded, strict=True)}
    assert check_pieces(rows, ids) < 0.03


def test_odd_rows(odd_documents):
    rows = packing.digest(packing.pack_documents(odd_documents, PATH)).collect()
    assert {r["doc_id"] for r in rows} == {None, 1, 2, 3, 4, 5, 6, 7, 8}
    assert all(r["doc_tokens"] == 1 for r in rows if r["doc_id"] in (1, 2, 3))
    assert sum(r["doc_id"] == 6 for r in rows) >= 2 and sum(r["doc_id"] == 5 for r in rows) > 1
    assert packing.pack_documents(odd_documents.limit(0), PATH).count() == 0
