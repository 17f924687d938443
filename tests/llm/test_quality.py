import re
from collections import Counter, defaultdict

import pytest

from tailwake.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(grams)
    covered = {i + d for i, g in enumerate(grams) if seen[g] > 1 for d in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))


def normal_lines(text):
    for line in (text or "").split("\n"):
        words = WORD.findall("".join(c.lower() if c.isascii() else c for c in line))
        if words:
            yield " ".join(words), len(words)


def brute(rows, limit, min_left):
    """rows of (doc_id, host, text); words in lines above the limit and the verdict of each."""
    held = []
    for _, host, text in rows:
        lines = Counter()
        for line, count in normal_lines(text):
            lines[line] += count
        held.append((host or "", lines, "\n".join(line for line, _ in normal_lines(text))))
    holders = defaultdict(set)
    for host, lines, content in held:
        for line in lines:
            holders[host, line].add(content)
    frequent = {k for k, v in holders.items() if len(v) > limit}
    out = []
    for (doc_id, _, text), (host, lines, _) in zip(rows, held, strict=True):
        gone = sum(n for line, n in lines.items() if (host, line) in frequent)
        counts = brute_counts(text)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        out.append((doc_id, *counts, failed, not failed and not counts[0] - gone < min_left * counts[0], gone))
    return out


@pytest.fixture(scope="module")
def corpus(make_text):
    """A footer on many pages, a family of near copies, exact copies, pages of nothing but boilerplate."""
    footer = "All rights reserved  by the FOOTER owners of this page\nnever copy a line of it"
    base = [make_text(100 + i, 60).replace("\n", " ") for i in range(8)]
    rows = [(i, "a", "\n".join([make_text(i, 80), footer])) for i in range(12)]
    for i in range(30):  # each near copy has a line of its own
        lines = list(base)
        lines[i % 8] = make_text(500 + i, 60).replace("\n", " ")
        rows.append((100 + i, "b", "\n".join(lines)))
    rows += [(200 + i, "b", "\n".join(base[:3])) for i in range(20)]
    menus = [" ".join(f"menu{m}{k}" for k in range(30)) for m in range(14)]
    rows += [(300 + i, "c", "\n".join(menus[j] for j in range(14) if (i >> (j % 4)) & 1 or j == i % 14)) for i in range(40)]
    rows += [(400 + i, "c", "\n".join([make_text(900 + i, 10), *menus[i % 3 : i % 3 + 5]])) for i in range(25)]
    return rows


def judged(spark, rows, **options):
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    return quality.judge_documents(table, **options)


@pytest.mark.parametrize("limit", [4, 10])
def test_against_brute_force(spark, corpus, limit):
    found = quality.digest(judged(spark, corpus, line_limit=limit)).collect()
    want = brute(corpus, limit, quality.MIN_LEFT)
    assert sorted(map(tuple, found)) == sorted(want)


def test_footers_go_and_copies_stay(spark, corpus):
    rows = {r["doc_id"]: r for r in judged(spark, corpus, line_limit=10).collect()}
    assert all(rows[i]["removed_words"] == 16 for i in range(12))
    # Copies count once, but these hold three lines of the family below and nothing else.
    assert all(rows[i]["removed_words"] == rows[i]["n_words"] for i in range(200, 220))
    # Near copies are distinct documents: seven of eight lines are the host's template.
    assert not any(rows[100 + i]["kept"] for i in range(30))


def test_copies_count_once(spark):
    text = "\n".join(" ".join(f"word{i}{k}" for k in range(30)) for i in range(4))
    rows = [(i, "a", text) for i in range(40)] + [(50 + i, "a", text.upper() + "\n \n") for i in range(40)]
    found = judged(spark, rows).collect()
    assert len(found) == 80 and all(r["kept"] and r["removed_words"] == 0 for r in found)


@pytest.mark.parametrize("share", [49, 60, 85])
def test_a_template_counts_whatever_its_share(spark, share):
    """Different documents of 100 words, a part of them in six template lines."""
    words = [f"t{k}" for k in range(share)]
    lines = [" ".join(words[i::6]) for i in range(6)]
    rows = [(i, "h", "\n".join([*lines, " ".join(f"d{i}w{k}" for k in range(100 - share))])) for i in range(1000)]
    found = judged(spark, rows).collect()
    assert sum(r["removed_words"] for r in found) == 1000 * share
    assert all(r["kept"] == (share < 80) for r in found)


def test_depleted_documents_go(spark):
    menus = [" ".join(f"menu{m}{k}" for k in range(30)) for m in range(3)]
    rows = [(i, "c", "\n".join([" ".join(f"own{i}x{k}" for k in range(400)), *menus])) for i in range(12)]
    rows.append((99, "c", "\n".join([*menus, "two words"])))
    found = {r["doc_id"]: r for r in judged(spark, rows, line_limit=10).collect()}
    assert not found[99]["kept"] and not found[99]["base_failed"] and found[0]["kept"]


def test_lines_leave_the_text(spark, corpus):
    from pyspark.sql import functions as F

    table = spark.createDataFrame(corpus[:12], "doc_id long, source string, text string")
    kept = judged(spark, corpus, line_limit=10).select("doc_id", "removed")
    rows = table.join(kept, "doc_id").select(
        "doc_id", "text", quality.without_lines(F.col("text"), F.col("removed")).alias("now")
    )
    for row in rows.collect():
        assert row["now"] == "\n".join(row["text"].split("\n")[:-2])


def test_odd_rows(odd_documents):
    rows = quality.digest(quality.judge_documents(odd_documents)).collect()
    assert len(rows) == 10
    by = {r["doc_id"]: tuple(r) for r in rows}
    texts = {r["doc_id"]: r["text"] for r in odd_documents.collect()}
    for doc_id, text in texts.items():
        assert by[doc_id][1:6] == brute_counts(text)
    assert by[1][6:8] == (True, False) and by[5][7] is True
    assert quality.judge_documents(odd_documents.limit(0)).count() == 0
