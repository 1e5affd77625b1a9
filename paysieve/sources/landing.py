"""Landing zone: directories of JSON Lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paysieve.schemas import CORRUPT_COLUMN, LANDING, LANDING_WITH_CORRUPT


def read_landing(spark: SparkSession, path: str | list[str], *, keep_corrupt: bool = False) -> DataFrame:
    """Scan with the fixed schema, never inferring.

    A malformed line becomes an all-NULL row, a wrongly typed field NULL, a
    blank line nothing.  ``keep_corrupt`` adds the raw text of such lines.
    """
    reader = spark.read.option("mode", "PERMISSIVE")
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        return reader.schema(LANDING_WITH_CORRUPT).json(path)
    return reader.schema(LANDING).json(path)
