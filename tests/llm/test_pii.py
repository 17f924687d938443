import hashlib
import random
import re
import time

import pytest

from tailwake.llm import pii

# The patterns as given, with plain backtracking.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def brute_luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def brute_base(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m)
    checks = {
        "email": (EMAIL, lambda m: True),
        "ip": (IP, lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (CARD, lambda m: 16 <= len(digits(m)) <= 19 and brute_luhn(digits(m))),
        "phone": (PHONE, lambda m: 8 <= len(digits(m)) <= 15),
    }
    return [
        (kind, m.start(), m.end())
        for kind, (pattern, check) in checks.items()
        for m in re.finditer(pattern, text)
        if check(m[0])
    ]


def base_of(text):
    return [(s["kind"], s["start"], s["end"]) for s in pii.find_spans(text) if s["base"]]


def added(text):
    return [(s["kind"], text[s["start"] : s["end"]]) for s in pii.find_spans(text) if not s["base"]]


PARTS = (
    "a b.c @ @@ . .. - 1 22 255 256 0255 1.2.3 1.2.3.4 9.9.9.9.9.9 300.1.1.1 me@x.org you@site you@a.b-c.d me@x.org_y@z.w "
    "4111111111111111 4111-1111-1111-1111 +1 +12345678 +1(2)345-6789 +49.30.1234567 ( ) é 😀 _%+- 123-45-6789 00000000000000000"
).split(" ")


@pytest.mark.parametrize("seed", range(300))
def test_base_spans_against_the_patterns(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(PARTS) + rng.choice(["", "", " ", ".", "-", "\n"]) for _ in range(rng.randint(1, 60)))
    assert base_of(text) == brute_base(text)


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE89370400440532013001")
    assert pii.mod97("GB82WEST12345698765432")


def test_context_decides_on_added_kinds():
    assert added("IBAN DE89 3704 0044 0532 0130 00 AND more") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert added("code DE89370400440532013001") == []
    assert added("my SSN is 123-45-6789.") == [("national_id", "123-45-6789")]
    assert added("item 123-45-6789 of") == [] and added("ssn 000-45-6789, 123-00-6789") == []
    assert added("please call (030) 555-1234 today") == [("local_phone", "(030) 555-1234")]
    assert added("table (030) 555-1234 today") == []
    assert added("credit card 3782 822463 10005") == [("short_card", "3782 822463 10005")]
    assert added("378282246310005") == [] and added("card 378282246310006") == []
    assert added("card of order 378282246310005") == []
    # A base span keeps its place.
    assert added("phone +1 (900) 555-2077") == []


def test_scores_move_with_context():
    score = lambda text: pii.find_spans(text)[0]["score"]
    assert score("host 10.0.0.1") > score("at 10.0.0.1") > score("version 10.0.0.1") > 0
    assert score("4111111111111111 visa") == 1.0


def test_masks():
    text = "Write to me@x.org or +1 (900) 555-2077, card 4111 1111 1111 1111."
    assert pii.mask(text) == "Write to [email] or [phone], card [card]."
    assert pii.mask("plain") == "plain" and pii.mask(None) is None


@pytest.mark.parametrize(
    "unit", ["a", "1", "1.", "a@", "a.", "@", "+1", "+1 ", "1 ", "1-", "(1) ", "A1", "12-", "DE12 ", "a@b", "123 456 789 ", "."]
)
def test_time_is_linear(unit):
    start = time.perf_counter()
    pii.find_spans(unit * (400_000 // len(unit)))
    assert time.perf_counter() - start < 5


def test_rows(spark, odd_documents):
    texts = {r["doc_id"]: r["text"] for r in odd_documents.collect()}
    made = [(100, "me@x.org, 1.2.3.4; +12345678 4111111111111111"), (101, "iban DE89370400440532013000")]
    docs = odd_documents.select("doc_id", "text", "row", "score", "found").unionAll(
        spark.createDataFrame([(*m, "x", 1, "y") for m in made], "doc_id long, text string, row string, score int, found string")
    )
    rows = pii.digest(pii.find_personal_data(docs)).collect()
    assert len(rows) == 12
    for row in rows:
        text = (texts | dict(made))[row["doc_id"]]
        base = brute_base(text)
        written = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert row["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert tuple(row[f"n_{k}"] for k in pii.BASE) == tuple(sum(b[0] == k for b in base) for k in pii.BASE)
        assert row["spans"].startswith(written)
    assert {r["doc_id"]: r["spans"] for r in rows}[101] == "iban:5:27"
    assert pii.digest(pii.find_personal_data(odd_documents.limit(0))).count() == 0


def test_query_against_the_patterns(spark):
    from tailwake.llm import queries

    sf_dir = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.queries()["op12_pii"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        written = ",".join(f"{k}:{s}:{e}" for k, s, e in brute_base(texts[row["doc_id"]]))
        assert row["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()


def test_masked_column(spark):
    from pyspark.sql import functions as F

    table = spark.createDataFrame([("mail me@x.org",), (None,), ("",)], "text string")
    assert [r[0] for r in table.select(pii.masked(F.col("text"))).collect()] == ["mail [email]", None, ""]
