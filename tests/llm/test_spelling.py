import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tailwake.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(run):
    return "".join(c.lower() if c.isascii() else c for c in run)


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                place = h % len(run)
                run = run[:place] + run[place + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows):
    words = brute_words(rows)
    links = defaultdict(list)
    for a in words:
        for b in words:
            if near(a, b):
                links[a].append(b)
    form = {}
    for word, others in links.items():
        best = min(others, key=lambda o: (-words[o], o))
        if words[best] >= 2 * words[word]:
            form[word] = best
    out = []
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        out.append((word, form.get(word), root, n, len(links[word]), words.get(form.get(word))))
    return sorted(out, key=repr)


def found(spark, rows):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    return sorted(map(tuple, spelling.digest(spelling.variants(table)).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    bases = ["".join(rng.choices("abcé", k=rng.randint(4, 9))) for _ in range(60)]
    out = []
    for i in range(150):
        words = []
        for _ in range(40):
            word = rng.choice(bases[: rng.randint(1, 60)])
            for _ in range(rng.choice((0, 0, 1, 2))):
                at = rng.randrange(len(word) + 1)
                word = word[:at] + rng.choice(["", "a", "b", "É", "ÿ"]) + word[at + rng.randint(0, 1) :]
            words.append(rng.choice((word, word.upper(), word + "Ā" + word)))
        out.append((i if i % 9 else None, rng.choice((" ", "-", "1", "\n")).join(words)))
    return out


def test_against_brute_force(spark, rows):
    want = brute(rows)
    assert len(want) > 150 and sum(w[1] is not None for w in want) > 30
    assert found(spark, rows) == want


def test_waves_lose_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(spelling, "WAVE_BLOCKS", 2)
    monkeypatch.setattr(spelling, "WORDS_A_BLOCK", 4)
    monkeypatch.setattr(spelling, "WORDS_A_TASK", 50)
    monkeypatch.setattr(spelling, "CHUNK", 64)
    assert found(spark, rows) == brute(rows)


def test_filters_have_no_false_negative_and_few_false_positives():
    import numpy as np

    rng = np.random.default_rng(1)
    words = np.unique(rng.integers(97, 123, (20_000, 7)).astype(np.uint8), axis=0)
    plan = spelling.Layout({7: len(words)})
    block, bits = plan.place(spelling._prefixes(words)[:, -1], 7)
    filters = np.zeros((plan.total, 8), np.uint64)
    for i in range(8):
        bit = np.uint64(1) << ((bits >> np.uint64(6 * i)) & np.uint64(63))
        np.bitwise_or.at(filters[:, i], block, bit)
    assert len(spelling.probe(filters, 0, block, bits)) == len(words)
    others = rng.integers(0xC0, 0x100, (100_000, 7)).astype(np.uint8)
    passed = spelling.probe(filters, 0, *plan.place(spelling._prefixes(others)[:, -1], 7))
    assert len(passed) < 1000


def test_ties_chains_and_long_words(spark):
    def doc(counts):
        return " ".join(" ".join([w] * n) for w, n in counts.items())

    long = "ab" * 3000
    counts = {
        "chain": 4, "chains": 8, "chainsa": 16, "chainsab": 32,  # each the form of the one before
        "tieda": 10, "tiedb": 10, "tiedc": 3, "tied": 50,
        "aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 5, "short": 2, "abcdz": 3,
        long: 3, long + "c": 7, "c" + long[1:]: 3,
    }
    rows = [(1, doc(counts)), (2, None), (3, ""), (4, "ab cd")]
    want = brute(rows)
    assert found(spark, rows) == want
    by = {w[0]: w for w in want}
    assert by["chain"][2] == "chainsab" and by["tiedc"][1] == "tieda" and by[long][4] == 2


def test_odd_rows(odd_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    out = spelling.digest(spelling.variants(odd_documents)).collect()
    words = brute_words(rows)
    assert {r["word"]: r["n"] for r in out} == words
    assert spelling.variants(odd_documents.limit(0)).count() == 0


def test_runs_as_they_stand(spark):
    table = spark.createDataFrame([(i, "plain words") for i in range(300)], "doc_id long, text string")
    got = spelling.variants(table, drop_every=None).collect()
    assert sorted((r["word"], r["n"], r["n_near"]) for r in got) == [("plain", 300, 0), ("words", 300, 0)]
