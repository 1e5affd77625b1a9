"""What several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysieve.sources import scratch_path

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; a NULL id counts as an empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text), F.lit(modulus))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, A to Z in lower case, as UTF-8."""
    return text.encode().lower().split() if text else []
