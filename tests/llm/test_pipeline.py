import re

import pytest

import corpus_pipeline
from tailwake.llm import quality, secrets, simhash

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before and after each stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(folder / str(place))
        stage(spark, docs, SF_DIR).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = ({r["doc_id"]: r for r in docs.collect()}, after.collect(), after.columns)
        docs = after
    return out


def test_columns(stages):
    for name, (_, _, columns) in stages.items():
        if name != "packing":
            assert tuple(columns) == corpus_pipeline.COLUMNS, name


def test_quality(spark, stages):
    before, after, _ = stages["quality rules"]
    from .test_quality import brute

    rows = [(r["doc_id"], r["source"], r["text"]) for r in before.values()]
    want = {r[0]: r for r in brute(rows, quality.LINE_LIMIT, quality.MIN_LEFT)}
    assert {r["doc_id"] for r in after} == {d for d, r in want.items() if r[7]}
    for row in after:
        gone = want[row["doc_id"]][8]
        assert len(before[row["doc_id"]]["text"].split()) - len(row["text"].split()) == gone
        assert (row["text"] == before[row["doc_id"]]["text"]) == (gone == 0)


def test_toxicity(stages):
    before, after, _ = stages["toxicity"]
    kept = {r["doc_id"] for r in after}
    bad = re.compile(r"\b(idiot|scum|moron|worthless|pathetic|loser)\b", re.IGNORECASE)
    toxic = {d for d, r in before.items() if len(bad.findall(r["text"])) > 1}
    assert not toxic & kept and len(before) - len(kept) < 2.5 * len(toxic) + 5


def test_near_duplicates(stages):
    from .test_simhash import brute_roots

    before, after, _ = stages["simhash near-dedup"]
    ids = sorted(before)
    roots = brute_roots([simhash.fingerprint(before[i]["text"]) for i in ids], simhash.MAX_BITS)
    assert sorted(r["doc_id"] for r in after) == sorted({ids[r] for r in roots})
    assert all(r == before[r["doc_id"]] for r in after)


def test_secrets(stages):
    before, after, _ = stages["secret scans"]
    assert len(after) == len(before)
    for row in after:
        assert not re.search(secrets.HEX, row["text"]) and not re.search(secrets.ACCESS, row["text"])
        if row["text"] != before[row["doc_id"]]["text"]:
            assert "[secret]" in row["text"] and row["n_chars"] == len(row["text"])


def test_packing_and_run(spark, stages):
    before, after, _ = stages["packing"]
    assert {r["doc_id"] for r in after} == set(before)
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    mark = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sum(r["length"] for r in whole) == sum(r["length"] for r in after)
    assert {r["doc_id"] for r in whole} == {r["doc_id"] for r in after} and set(mark) < set(whole[0].asDict())


def test_odd_rows(spark, odd_documents, tmp_path):
    docs = odd_documents
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / f"{place}"))
        assert stage(spark, odd_documents, SF_DIR).count() >= 0
        assert stage(spark, odd_documents.limit(0), SF_DIR).count() == 0
        docs = spark.read.parquet(str(tmp_path / f"{place}"))
    # Alone, near-duplicate removal keeps one of the three equal rows and one of the empty ones.
    kept = corpus_pipeline.near_duplicates(spark, odd_documents, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] in (1, 2, 3, 6, 7)) == [1, 6]
    assert any(r["doc_id"] is None for r in kept)
