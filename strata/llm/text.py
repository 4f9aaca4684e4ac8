"""Text and table helpers shared by the operators of this subpackage.

The word rules work on UTF-8 bytes: every separator they name is ASCII, so a
byte-wise rule and a character-wise rule give the same words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: bytes.split() without an argument splits at exactly [\x20\x09-\x0D].
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Every ASCII byte that is not a digit or a letter becomes a blank; A-Z are lower-cased.
ALNUM_LOWER = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


#: What this process remembers between tasks: one operator's memory at a time.
_REMEMBERED: dict = {}


def remembered(key, make: Callable):
    """This process's object under ``key``, kept until another one is asked for.

    Workers run tasks of several operators one after the other; each
    operator's memory of words is bounded, and only one is ever held.
    """
    if key not in _REMEMBERED:
        _REMEMBERED.clear()
        _REMEMBERED[key] = make()
    return _REMEMBERED[key]


def forget() -> None:
    """Lets go of what this process remembers."""
    _REMEMBERED.clear()


def raw(text: str | None) -> bytes:
    """UTF-8 of a text; a null is an empty text."""
    return b"" if text is None else text.encode("utf-8")


def lower_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased."""
    return raw(text).translate(LOWER_ASCII).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n (a null id counts as '')."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array (none for a null)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh(columns: list[str], *names: str) -> list[str]:
    """Names that no column has, for columns that are only used inside."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out
