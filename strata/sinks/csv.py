"""CSV writer that keeps values byte-exact (used to stage source files).

Spark's CSV writer trims leading and trailing spaces by default; both are
turned off so padded values survive a round trip. An empty string and a null
both come back as null: the CSV reader treats every empty field as missing,
which is the source contract (blank fields arrive as null).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    (
        df.write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(str(path))
    )
