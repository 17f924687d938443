import math

import numpy as np

from tailwake.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, ids int, values string"


def brute(rows, asked, k):
    ready = [
        (i, [math.floor(64 * float(np.float32(x))) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    queries = {}
    for i, v in ready:
        if asked(i) and (i not in queries or v < queries[i]):
            queries[i] = v
    out = []
    for q, v in queries.items():
        scores = [(-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in ready if i != q]
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def found(spark, rows, k=5):
    table = spark.createDataFrame([(*r, 0, 1, "z") for r in rows], SCHEMA)
    result = topk.top_k(table, table.where("vec_id % 10 = 0"), k)
    return sorted(tuple(r) for r in result.collect())


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 40)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.integers(-3, 4, 8) / 8).tolist()) for i in range(300)]  # many ties and zeros
    rows += [(i, None if i % 2 else [0.0] * 8) for i in range(300, 310)]
    rows += [(311, [1.0, None] * 4), (312, [float("nan")] * 8), (313, [float("inf")] * 8), (314, [])]
    rows += [(None, [1.0] * 8), (320, [0.5] * 3), (-10, [0.25] * 8)]
    rows += [(5, rows[5][1])] * 3 + [(10, [9.0] * 8), (10, [-9.0] * 8)]
    want = brute(rows, lambda i: i % 10 == 0, 5)
    assert found(spark, rows) == want


def test_large_numbers_and_few_candidates(spark):
    rows = [(0, [3e6, -3e6]), (1, [2e6, 1e6]), (2, [-1e6, 5.5])]
    assert found(spark, rows) == brute(rows, lambda i: i % 10 == 0, 5)
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, []) == []


def test_sparse_postings():
    rng = np.random.default_rng(2)
    dense = np.where(rng.random((90, 30)) < 0.1, rng.integers(-9, 9, (90, 30)), 0)
    ids = np.arange(90)
    q, c, s = topk.best(ids[:40], dense[:40], ids, dense, 4)
    scores = dense[:40] @ dense.T
    for i in range(40):
        order = sorted((-scores[i, j], j) for j in range(90) if j != i)[:4]
        rows = q == i
        assert sorted(zip((-s[rows]).tolist(), c[rows].tolist(), strict=True)) == order


def test_copies_do_not_pass_through_the_driver(spark, monkeypatch):
    """Neither side is small once it is copied for each block of the other, whatever its files measure."""
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 16)
    rows = spark.createDataFrame([(i, [float(i), 1.0], 0, 1, "z") for i in range(200)], SCHEMA)
    result = topk.top_k(rows, rows.where("vec_id % 10 = 0"), 5)
    assert "Broadcast" not in result._jdf.queryExecution().executedPlan().toString()


def test_many_cells_against_brute_force(spark, monkeypatch):
    for name in ("QUERY_BLOCK", "CANDIDATE_BLOCK", "QUERY_SLOT", "CANDIDATE_SLOT", "TASKS"):
        monkeypatch.setattr(topk, name, {"QUERY": 3, "CANDIDATE": 16, "TASKS": 7}[name.split("_")[0]])
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-2, 3, 6) / 8).tolist()) for i in range(400)]  # ties across blocks and cells
    rows += [(i, (1000 * rng.random(i % 5 + 1)).tolist()) for i in range(400, 440)]
    rows += [(7, rows[7][1])] * 20 + [(20, [0.5] * 6)] * 20
    assert found(spark, rows, 6) == brute(rows, lambda i: i % 10 == 0, 6)


def test_blocks_keep_all_rows_in_the_narrowest_type(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_VALUES", 12)
    vectors = {1: [1, -128], 2: [127], 3: [300, 2, 3, 4, 5, 6, 7], 4: [-9], 5: [1 << 40], 6: [0] * 20}
    table = spark.createDataFrame(list(vectors.items()), "id long, values array<long>").coalesce(1)
    got, widths = {}, {}
    for block in topk.blocks(table, 100).collect():
        matrix = topk._matrix(block["width"], block["lengths"], block["values"])
        lengths = np.frombuffer(block["lengths"], np.int32)
        assert block["n"] == 1 or matrix.size <= 12
        assert block["size"] == matrix.nbytes + 12 * block["n"]
        ids = np.frombuffer(block["ids"], np.int64).tolist()
        for i, row, length in zip(ids, matrix, lengths, strict=True):
            got[i], widths[i] = row[:length].tolist(), block["width"]
    assert got == vectors
    assert widths[1] == 1 and widths[5] == 8


def test_scores_below_the_best_so_far_are_passed_over():
    rng = np.random.default_rng(4)
    dense = rng.integers(-3, 4, (120, 6))
    ids = np.arange(120)
    asked = topk.Asked([(ids[:30], dense[:30].astype(np.int8))], 4)
    for at in (80, 0, 40):  # a tie may come later, by a smaller id
        asked.meet(ids[at : at + 40], dense[at : at + 40].astype(np.int8))
    whole = topk.merged((np.empty(0, np.int64),) * 3, topk.best(ids[:30], dense[:30], ids, dense, 4), 4)
    assert [x.tolist() for x in asked.found] == [x.tolist() for x in whole]
    # The last block gives few rows more: what can't be among the best is not kept.
    assert len(topk.best(ids[:30], dense[:30], ids[40:80], dense[40:80], 4, asked.least.tolist())[0]) < 30 * 4


def test_slots_are_few():
    """Cells are as many as memory and cores ask for, and bytes are not copied for each block."""
    asked, rows = 30_769, 615_384  # the size of 6 GB
    across, along = topk.slots(asked, 76 * asked, rows, 76 * rows, 20, 6)
    assert across * along >= 24
    assert across * 76 * rows + along * 76 * asked < 2 * 256 * rows
    assert topk.slots(25, 76 * 25, 500, 76 * 500, 20, 6) == (1, 1)
    assert topk.slots(0, 0, 0, 0, 20, 6) == (1, 1)
    across, along = topk.slots(10**6, 10**9, 2 * 10**7, 10**11, 20, 6)
    assert across * topk.QUERY_SLOT >= 10**6 and along * topk.CANDIDATE_BYTES >= 10**11
