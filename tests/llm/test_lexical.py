import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tailwake.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, top=10):
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counted = [(d, c, c.total()) for d, c in counted if c]
    n, size = len(counted), sum(s for _, _, s in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item_id, text in set(items):
        found = []
        for doc_id, c, s in counted:
            m = 100 - 75 + (75 * s * n) // size
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms(text)
                if t in c
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item_id, rank + 1, d, -s) for rank, (s, _, d) in enumerate(found[:top])]
    return sorted(out, key=repr)


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, place int, term string")
    i = spark.createDataFrame([(*r, 1, "x") for r in items], "item_id long, text string, key int, number string")
    return sorted(map(tuple, lexical.search(d, i, **options).collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)] + ["Élan", "naïve", "日本", "a1b2"]
    weights = [1 / (i + 1) for i in range(len(words))]

    def text(n):
        return "".join(w + rng.choice([" ", ", ", "-", "\n", "_"]) for w in rng.choices(words, weights, k=n))

    docs = [(i, text(rng.randint(0, 80))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(30)]  # copies: ties
    docs += [(5, docs[5][1]), (5, "w1 w2 other"), (None, docs[7][1]), (None, docs[9][1]), (900, None), (901, ""), (902, "?!")]
    items = [(i, text(rng.randint(0, 30))) for i in range(40)]
    items += [(3, items[3][1]), (3, "w150 w150 W150 élan"), (50, None), (51, "unknown words"), (None, "w5"), (52, docs[7][1])]
    return docs, items


def test_against_brute_force(spark, corpus):
    docs, items = corpus
    assert found(spark, docs, items) == brute(docs, items)


def test_many_shards_blocks_and_stages(spark, corpus, monkeypatch):
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", 700)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 9)
    monkeypatch.setattr(lexical, "FLUSH", 100)
    docs, items = corpus
    assert found(spark, docs, items, top=4, owners=5) == brute(docs, items, 4)
    assert found(spark, docs, items, owners=1) == brute(docs, items)


def test_packing_of_scores():
    rng = np.random.default_rng(4)
    for n in (0, 1, 7, 8, 100):
        scores = rng.integers(0, 1 << 50, n) * rng.integers(0, 2, n)
        assert (lexical.unpack(*lexical.pack(scores), n) == scores).all()
    assert (lexical.unpack(None, None, 5) == 0).all()


def test_terms():
    text = "The_Quick-brown\x7ffox É1\u0085x y 日本\x00z"
    assert [t.decode() for t in lexical.terms_of(text)] == terms(text)


def test_odd_rows(spark, odd_documents):
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    items = [(1, "same ROW at all"), (2, None), (3, "one emoji"), (4, docs[4][1][:3000])]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, lexical.search(odd_documents, table).collect()), key=repr)
    assert got == brute(docs, items)
    assert lexical.search(odd_documents.limit(0), table).count() == 0
    assert lexical.search(odd_documents, table.limit(0)).count() == 0
