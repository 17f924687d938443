import numpy as np
import pytest
import xxhash

from tailwake.llm import simhash


def brute_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    cut = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(c, seed=42) for c in cut]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_roots(bits, max_bits):
    root = list(range(len(bits)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(bits)):
        for j in range(i):
            if bin(bits[i] ^ bits[j]).count("1") <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(bits))]


def near(rng, center, flips):
    for b in rng.choice(64, flips, replace=False):
        center ^= 1 << int(b)
    return center


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(3)
    centers = [int(c) for c in rng.integers(0, 2**63, 12)]
    chain = [centers[0]]
    for _ in range(25):
        chain.append(near(rng, chain[-1], 4))
    ball = [near(rng, centers[1], int(rng.integers(0, 4))) for _ in range(150)]
    apart = [near(rng, c, 5) for c in centers]
    return sorted(set(centers + chain + ball + apart))


@pytest.mark.parametrize("node_size", [4096, 20])
def test_links_join_exactly_the_linked(spark, values, node_size):
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    edges = simhash.links(spark.createDataFrame(signed, "bits long"), 4, node_size)
    found = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    want = brute_roots(values, 4)
    groups, expected = {}, {}
    for (bits,), root in zip(signed, want, strict=True):
        groups.setdefault(found.get(bits, bits), set()).add(bits)
        expected.setdefault(root, set()).add(bits)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    rows = simhash.components(edges).collect()
    assert len(rows) == 201 and {r["root"] for r in rows} == {0}


def test_documents_against_brute_force(spark, make_text):
    texts = [make_text(i, 60) for i in range(40)]
    texts += [t.replace("the", "The") for t in texts[:5]] + [texts[0] + " extra", "", None, "one two"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: tuple(r)[1:] for r in simhash.digest(simhash.near_duplicates(rows)).collect()}
    bits = [brute_fingerprint(t) for t in texts]
    roots = brute_roots(bits, 4)
    for i, b in enumerate(bits):
        assert found[i] == (f"{b:016x}", roots[i]), i


def test_odd_rows(odd_documents):
    found = simhash.digest(simhash.near_duplicates(odd_documents)).collect()
    assert len(found) == 10
    by = {r["doc_id"]: r for r in found}
    assert by[1]["fingerprint"] == by[3]["fingerprint"] == "0" * 16
    assert by[3]["component_id"] == 1 and by[7]["component_id"] == 6
    assert by[None]["component_id"] is None
    assert simhash.near_duplicates(odd_documents.limit(0)).count() == 0
