"""A layout for point lookups: one flight, one aircraft, one airline.

Rows are dealt to files by ranges of the key and sorted by it, so a lookup by key opens the one file,
and in it the one page, whose statistics hold the value. Other columns that are asked for get Bloom
filters: row groups without the value are not read. Both are parquet's own; a reader filters on the bare
column and needs to know nothing of the layout.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

ROWS_A_FILE = 1_000_000
ROWS_A_GROUP_BYTES = 16 << 20


def store(
    rows: DataFrame,
    path: str,
    key: str,
    also: Iterable[str] = (),
    rows_a_file: int = ROWS_A_FILE,
    mode: str = "errorifexists",
) -> None:
    """Write ``rows`` for lookups by ``key``, and by the columns in ``also``.

    A key that a third of all rows share fills its own range, which adaptive execution does not split:
    use a key that names rows, and put the others in ``also``.
    """
    files = -(-rows.count() // rows_a_file) or 1
    writer = (
        rows.repartitionByRange(files, key)
        .sortWithinPartitions(key)
        .write.mode(mode)
        .option("parquet.block.size", str(ROWS_A_GROUP_BYTES))
    )
    for column in (key, *also):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)
