"""URL filter: a sort-merge range join of hosts with nested rules.

A host is written with its labels reversed and a dot after each (``net.example.www.``). A rule's host
is then a prefix, that is the interval from ``net.example.`` up to ``net.example/``: the dot is
followed by the slash in the alphabet, so the interval holds the host and all its subdomains and
nothing else. Intervals are nested or apart. One sorted sweep over interval edges and hosts carries
the stack of active rules: an edge that opens an interval puts its rules on the stack of the
enclosing ones, an edge that closes it leaves the enclosing ones. Each host takes the stack of the
last edge before it, and each url the longest rule of its host's stack whose path fits.

The sweep works on distinct hosts, so a host with a third of all urls is one row, in slices by the
two last labels and a hash of the third, so a domain with many subdomains is split; rules on one or
two labels are copied to the slices they cover. Only the join of urls with their host's stack sees
all rows: an equality join, whose hot hosts adaptive execution splits. Rules of one host travel as
one array. Built-in functions only.

Defined cases: a null url or one without ``://`` has an empty host and path, which no rule fits.
Rules with a null or empty host, a null path or verdict are ignored; of equal rules with different
verdicts block wins. Length is that of host and path together; of equal lengths the longer host
wins, then the later text. Repeated rows are judged each; without rows or rules the result is empty
or all default. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tailwake.llm.common import ascii_lower

# The rules of the contract.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
DEFAULT = "allow"
SALTS = 16
SLICE = ("first", "second", "salt")


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """The rules as one literal in the plan, so that no Python worker reads them."""
    names = ("host", "path", "verdict")
    written = [
        F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, rule, strict=True)])
        for rule in rules or RULES
    ]
    table = spark.range(1).select(F.inline(F.array(*written)))
    return table if rules else table.limit(0)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _sliced(hosts: DataFrame) -> DataFrame:
    labels = F.reverse(F.split("host", r"\."))
    return hosts.select(
        "*",
        F.concat(F.array_join(labels, "."), F.lit(".")).alias("key"),
        F.size(labels).alias("depth"),
        F.get(labels, F.lit(0)).alias("first"),
        F.coalesce(F.get(labels, F.lit(1)), F.lit("")).alias("second"),
        F.pmod(F.xxhash64(F.coalesce(F.get(labels, F.lit(2)), F.lit(""))), F.lit(SALTS)).alias(
            "salt"
        ),
    )


def _stacks(rules: DataFrame) -> DataFrame:
    """Each rule host with the rules on itself and on the hosts that enclose it."""
    nodes = rules.groupBy("host").agg(F.collect_list("rule").alias("own"))
    labels = F.split("host", r"\.")
    outer = nodes.select(
        F.col("host").alias("inner"),
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size(labels)),
                lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
            )
        ).alias("host"),
    )
    return (
        outer.join(nodes, "host")
        .groupBy(F.col("inner").alias("host"))
        .agg(F.flatten(F.collect_list("own")).alias("stack"))
    )


def host_stacks(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``host`` with the ``stack`` of rules active there, by the sorted sweep."""
    hosts = _sliced(hosts.select("host").where("host != ''").distinct())
    slices = hosts.select(*SLICE).distinct()
    nodes = _sliced(_stacks(rules)).withColumn(
        "outer", F.filter("stack", lambda r: F.length(r.host) < F.length("host"))
    )
    copied = (
        nodes.where("depth >= 3"),
        nodes.where("depth = 2").drop("salt").join(slices, ["first", "second"]),
        nodes.where("depth = 1").drop("second", "salt").join(slices, ["first"]),
    )
    nodes = copied[0].unionByName(copied[1]).unionByName(copied[2])
    opens = nodes.select(*SLICE, "key", "stack")
    closes = nodes.select(
        *SLICE,
        F.concat(F.expr("left(key, length(key) - 1)"), F.lit("/")).alias("key"),
        F.col("outer").alias("stack"),
    )
    edges = opens.unionByName(closes).withColumn("host", F.lit(None).cast("string"))
    points = edges.unionByName(
        hosts.select(*SLICE, "key", "host"), allowMissingColumns=True
    )
    sweep = (
        Window.partitionBy(*SLICE)
        .orderBy("key", F.col("host").isNotNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        points.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep))
        .where("host is not null and size(stack) > 0")
        .select("host", "stack")
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
    default: str = DEFAULT,
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, the winning rule as text or null, verdict."""
    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.col(id_col).alias(id_col), host.alias("host"), path.alias("path"))
    ready = (
        rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict")
        .where("host != '' and path is not null and verdict is not null")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            "host",
            F.struct(
                F.length(F.concat("host", "path")).alias("size"),
                F.length("host").alias("host_size"),
                F.concat("host", "path").alias("text"),
                "verdict",
                "path",
                "host",
            ).alias("rule"),
        )
    )
    stacks = host_stacks(urls, ready)
    best = F.array_max(F.filter("stack", lambda r: F.startswith(F.col("path"), r.path)))
    return urls.join(stacks, "host", "left").withColumn("best", best).select(
        id_col,
        "host",
        "path",
        F.col("best.text").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
