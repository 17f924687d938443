import numpy as np
import public_tokenizers
import pytest

from tailwake.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


def brute(model, vocabulary, text):
    """Viterbi over characters of the whole text, without cuts, trie or lanes."""
    if not text:
        return []
    text = " " + text.replace(pieces.MARK, " ")
    best = [(0.0, None, None)] + [None] * len(text)
    for at in range(len(text)):
        if best[at] is None:
            continue
        for stop in range(at + 1, min(len(text), at + 20) + 1):
            found = vocabulary.get(text[at:stop])
            if found is None and stop > at + 1:
                continue
            score = best[at][0] + (model.unknown if found is None else model.scores[found])
            if best[stop] is None or score > best[stop][0]:
                best[stop] = (score, at, found)
    ids, at = [], len(text)
    while at:
        _, start, found = best[at]
        if found is None:
            ids += [int(model.byte_ids[b]) for b in reversed(text[start:at].encode())]
        else:
            ids.append(found)
        at = start
    return ids[::-1]


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces.load(PATH)


@pytest.fixture(scope="module")
def vocabulary(model):
    return {
        p.decode(): i for i, p in enumerate(model.out) if p and not model.is_byte[i] and i > 2
    }


def test_double_array_finds_what_it_holds():
    entries = {w.encode(): i for i, w in enumerate(["a", "ab", "abc", "b", "ébc", "日本", "日"])}
    trie = pieces.DoubleArray(entries)
    for word in [*entries, b"ac", b"abcd", "é".encode(), b"zz"]:
        state = 0
        for byte in word:
            following = trie.base[state] + byte
            state = following if trie.base[state] and trie.check[following] == state else None
            if state is None:
                break
        assert (-1 if state is None else trie.value[state]) == entries.get(word, -1)


def test_ids_match_brute_force(model, vocabulary, make_text):
    texts = [
        "", " ", "  a  b ", "a\tb\nc\n\n d", "ﬁ ½ Å 日本語 \U0001f600 x\x00y", "a▁b", "\n", "\n x",
        "x" * 200, "ééé" * 30, make_text(1, 150), make_text(2, 150), "\r\n\x0b 　z",
    ]
    found = [np.frombuffer(i, "<u4").tolist() for i in model.encode(texts)]
    for text, ids in zip(texts, found, strict=True):
        assert ids == brute(model, vocabulary, text), text[:40]
        assert model.decode(np.array(ids, "<u4").tobytes()) == text.replace(pieces.MARK, " ")


def test_lanes_and_memory_do_not_matter(model, make_text, monkeypatch):
    texts = [make_text(s, 80) for s in range(6)]
    want = list(model.encode(texts))
    monkeypatch.setattr(pieces, "LANE_BYTES", 50)
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    monkeypatch.setattr(pieces, "CHUNK", 2)
    model.known.clear()
    assert list(model.encode(texts)) == want


def test_whole_table_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pieces.digest(pieces.encode_documents(docs, PATH)).collect()
    assert len(rows) == 1000 and all(r["round_trip"] for r in rows)


def test_odd_rows(odd_documents):
    rows = pieces.digest(pieces.encode_documents(odd_documents, PATH)).collect()
    assert len(rows) == 10 and all(r["round_trip"] for r in rows)
    assert {r["n_ids"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert pieces.encode_documents(odd_documents.limit(0), PATH).count() == 0
