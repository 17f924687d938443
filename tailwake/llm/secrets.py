"""Secret scan: entropy of sliding windows over candidate strings, beside fixed patterns.

Only built-in column functions, no shuffle: each text is scanned by regular expressions, and what
they find is worked on in arrays of the same row.

* Base spans follow three patterns, leftmost and without overlap within a kind.
* The method adds runs of at least WINDOW characters of the base64 alphabet. A window slides over
  each run; the number of times each character occurs in it is kept up to date by adding the
  character that enters and taking away the one that leaves, and so is the sum of c * log2(c), from
  which the window's Shannon entropy follows. Each window has the class of its own characters, so a
  key keeps its class beside a prefix. A run with a window that reaches the limit of its class is a
  secret of the widest such class, unless it overlaps a base span.
* The allow list takes out what it matches: a whole run, the words of a run that hold a listed
  string, or the folder that a path begins with; no window lies across that. In a path the words
  between the separators (/ _ -) are judged each by itself.

Defined cases: a null text counts as empty; an empty text has no spans, and its digest is that of
the empty string. Positions are code points, ends exclusive. Rows that repeat are scanned each.
Other columns are ignored, whatever their names. Work on a text of n characters with m matches is
proportional to n and to m * sqrt(m).
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base spans.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6
BASE_KINDS = ("assign", "access", "hex")

#: Width of the sliding window, and the entropy in bits that a window must reach by class.
WINDOW = 20
LIMITS = {"entropy_hex": 3.0, "entropy_alnum": 3.6, "entropy_mixed": 3.9}
KINDS = (*BASE_KINDS, *LIMITS)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
RUN = rf"[A-Za-z0-9+/_-]{{{WINDOW},}}={{0,2}}"
#: Strings that look random and are known to be harmless.
ALLOW_PARTS = ("(?i)example|sample|placeholder|dummy|changeme", "(?i)0123456789|abcdefghijklm")
ALLOW_RUNS = (
    "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    "^[a-z]+([-_/][a-z]+)+$",
    "^(da39a3ee5e6b4b0d3255bfef95601890afd80709|d41d8cd98f00b204e9800998ecf8427e)$",
)
ALLOW_PATH = "^/?(usr|etc|var|home|opt|tmp)/"
ALLOW = (*ALLOW_PARTS, *ALLOW_RUNS, ALLOW_PATH)
#: Stands for what the allow list takes out of a run.
BREAK = "."

_SPAN = "struct<start:bigint,rank:int,stop:bigint>"
_STEP = "struct<gap:bigint,size:bigint>"
_BLOCK = 512


def _placed(text: Column, pattern: str, hits: Column, rank: int) -> Column:
    """The places of ``hits`` in ``text``, from the lengths of what lies between them. Lengths are
    added up in blocks, as appending to one long array would take quadratic time."""
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(
        F.slice(gaps, 1, F.size(hits)),
        hits,
        lambda gap, hit: F.struct(
            F.length(gap).cast("long").alias("gap"), F.length(hit).cast("long").alias("size")
        ),
    ).cast(f"array<{_STEP}>")
    count = F.floor((F.size(hits) + (_BLOCK - 1)) / _BLOCK).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), count - 1), lambda b: F.slice(steps, b * _BLOCK + 1, _BLOCK)
    )
    heads = F.aggregate(
        F.transform(
            blocks,
            lambda block: F.aggregate(block, F.lit(0).cast("long"), lambda a, s: a + s.gap + s.size),
        ),
        F.array(F.lit(0).cast("long")),
        lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)),
    )

    def place(block: Column, head: Column) -> Column:
        start = F.struct(head.alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))
        return F.aggregate(
            block,
            start,
            lambda a, s: F.struct(
                (a.at + s.gap + s.size).alias("at"),
                F.concat(
                    a.spans,
                    F.array(
                        F.struct(
                            (a.at + s.gap).alias("start"),
                            F.lit(rank).alias("rank"),
                            (a.at + s.gap + s.size).alias("stop"),
                        )
                    ),
                ).alias("spans"),
            ),
            lambda a: a.spans,
        )

    return F.when(F.size(hits) == 0, F.array().cast(f"array<{_SPAN}>")).otherwise(
        F.flatten(F.zip_with(blocks, F.slice(heads, 1, count), place))
    )


def _any(patterns: tuple[str, ...]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def _without_allowed(run: Column) -> Column:
    """``run`` with BREAK in place of what the allow list matches in it."""
    path, listed = run.rlike(ALLOW_PATH), run.rlike(_any(ALLOW_PARTS))
    words = F.regexp_replace(F.regexp_replace(run, ALLOW_PATH, BREAK), "[/_-]", BREAK)
    parts = F.transform(
        F.split(F.when(path, words).otherwise(run), "(?=[/_.-])", -1),
        lambda p: F.when(p.rlike(_any(ALLOW_PARTS)), BREAK).otherwise(p),
    )
    return F.when(path | listed, F.array_join(parts, "")).otherwise(run)


def window_rank(run: Column) -> Column:
    """The highest rank in KINDS of the windows of WINDOW characters of ``run`` whose Shannon entropy
    reaches the limit of their class; -1 if there is none."""
    weigh = F.array(*[F.lit(c * log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    alphabet = ALPHABET + BREAK
    chars = F.transform(
        F.regexp_extract_all(run, F.lit("."), 0), lambda c: F.instr(F.lit(alphabet), c)
    )
    # A window is of a class if the last character outside of it lies before the window.
    classes = {
        "lower_hex": "0123456789abcdef",
        "upper_hex": "0123456789ABCDEF",
        "lower": "0123456789abcdefghijklmnopqrstuvwxyz",
        "upper": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "any": ALPHABET,
    }
    members = {name: F.array(*[F.lit(c in held) for c in alphabet]) for name, held in classes.items()}

    def slide(state: Column, at: Column) -> Column:
        enters = F.element_at(state.chars, at)
        leaves = F.when(at > WINDOW, F.element_at(state.chars, F.greatest(at - WINDOW, F.lit(1))))
        leaves = F.coalesce(leaves, F.lit(0))
        seen_in = F.element_at(state.counts, enters + 1)
        seen_out = F.element_at(state.counts, leaves + 1)
        change = (
            F.element_at(weigh, seen_in + 2)
            - F.element_at(weigh, seen_in + 1)
            + F.when(leaves == 0, F.lit(0.0)).otherwise(
                F.element_at(weigh, seen_out) - F.element_at(weigh, seen_out + 1)
            )
        )
        total = F.when(enters == leaves, state.total).otherwise(state.total + change)
        counts = F.transform(
            state.counts,
            lambda c, i: c
            + F.when(i == enters, 1).otherwise(0)
            - F.when((i == leaves) & (leaves > 0), 1).otherwise(0),
        )
        outside = {
            name: F.when(F.element_at(held, enters), state[name]).otherwise(at)
            for name, held in members.items()
        }

        def within(name: str) -> Column:
            return outside[name] <= at - WINDOW

        bits = F.lit(log2(WINDOW)) - total / WINDOW
        hex_, alnum, mixed = (
            F.when(bits >= limit, KINDS.index(kind)).otherwise(-1) for kind, limit in LIMITS.items()
        )
        rank = (
            F.when(~within("any"), -1)
            .when(within("lower_hex") | within("upper_hex"), hex_)
            .when(within("lower") | within("upper"), alnum)
            .otherwise(mixed)
        )
        return F.struct(
            state.chars.alias("chars"),
            counts.alias("counts"),
            total.alias("total"),
            *[last.alias(name) for name, last in outside.items()],
            F.greatest(state["rank"], rank).alias("rank"),
        )

    start = F.struct(
        chars.alias("chars"),
        F.array_repeat(F.lit(0), len(alphabet) + 1).alias("counts"),
        F.lit(0.0).alias("total"),
        *[F.lit(0).alias(name) for name in classes],
        F.lit(-1).alias("rank"),
    )
    return F.aggregate(F.sequence(F.lit(1), F.length(run)), start, slide, lambda s: s["rank"])


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s.start, s.stop),
        ),
        ",",
    )


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` in one struct ``row``, the text as ``body`` (null: empty), and the
    found spans: ``base`` and ``added``, arrays of (start, rank in KINDS, stop), each sorted."""
    found = docs.select(
        F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("body")
    )
    body = F.col("body")
    found = found.select(
        "row",
        "body",
        *[
            F.regexp_extract_all(body, F.lit(p), 0).alias(n)
            for n, p in (("m0", ASSIGN), ("m1", ACCESS), ("m2", HEX), ("m3", RUN))
        ],
    )
    found = found.select(
        "row",
        "body",
        "m3",
        F.when(F.size("m0") > 0, F.regexp_extract_all(body, F.lit(ASSIGN), 2)).alias("values"),
        *[
            _placed(body, p, F.col(n), rank).alias(f"p{rank}")
            for rank, (n, p) in enumerate((("m0", ASSIGN), ("m1", ACCESS), ("m2", HEX), ("m3", RUN)))
        ],
    )
    long_values = F.filter(
        F.zip_with(
            F.col("p0"),
            F.coalesce(F.col("values"), F.array().cast("array<string>")),
            lambda s, v: F.struct(s.alias("span"), (F.length(v) >= ASSIGN_VALUE).alias("kept")),
        ),
        lambda x: x.kept,
    )
    found = found.select(
        "row",
        "body",
        "m3",
        "p3",
        F.array_sort(
            F.concat(F.transform(long_values, lambda x: x.span), F.col("p1"), F.col("p2"))
        ).alias("base"),
    )
    candidates = F.filter(
        F.arrays_zip(F.col("p3").alias("span"), F.col("m3").alias("run")),
        lambda c: ~c.run.rlike(_any(ALLOW_RUNS))
        & ~F.exists(
            F.col("base"), lambda s: (s.start < c.span.stop) & (c.span.start < s.stop)
        ),
    )
    ranked = F.transform(
        candidates,
        lambda c: F.struct(
            c.span.start.alias("start"),
            window_rank(_without_allowed(c.run)).alias("rank"),
            c.span.stop.alias("stop"),
        ),
    )
    added = F.filter(ranked, lambda c: c["rank"] >= 0)
    empty = F.array().cast(f"array<{_SPAN}>")
    return found.select(
        "row",
        "body",
        "base",
        F.when(F.size("m3") > 0, F.array_sort(added)).otherwise(empty).alias("added"),
    )


def digest(scanned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per document: counts by base kind, digest of the base spans, and all spans as text."""

    def count(rank: int) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")

    return scanned.select(
        F.col(f"row.{doc_id}").alias("doc_id"),
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(BASE_KINDS)],
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"),
    )


def redact(scanned: DataFrame, mark: str = "[secret]") -> Column:
    """``body`` with every stretch covered by spans replaced by ``mark``."""
    body = F.col("body")
    start = F.struct(
        F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts")
    )

    def step(a: Column, s: Column) -> Column:
        between = F.substring(body, (a.at + 1).cast("int"), (s.start - a.at).cast("int"))
        parts = F.when(s.start >= a.at, F.concat(a.parts, F.array(between, F.lit(mark))))
        return F.struct(
            F.greatest(a.at, s.stop).alias("at"), parts.otherwise(a.parts).alias("parts")
        )

    def finish(a: Column) -> Column:
        rest = F.substring(body, (a.at + 1).cast("int"), F.length(body))
        return F.concat(F.array_join(a.parts, ""), rest)

    spans = F.array_sort(F.concat("base", "added"))
    return F.when(F.size(spans) == 0, body).otherwise(F.aggregate(spans, start, step, finish))
