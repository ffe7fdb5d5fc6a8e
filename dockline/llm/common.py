"""Helpers shared by the corpus operators."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import session as SESSION

# A word is a maximal run of anything but the six ASCII blanks.
BLANK_CLASS = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\f\r"
HAS_WORD = r"[^\x20\x09-\x0D]"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of ``text``; empty for null and blank texts."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, BLANK_CLASS + "+"))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: the lineage is cut and a
    lost executor costs nothing but the current stage."""
    return SESSION.materialize(df, f"llm-{name}")


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``materialize`` that nothing reads again."""
    SESSION.discard(*tables)


def own(df: DataFrame, taken, base: str) -> str:
    """A column name that neither ``df`` nor ``taken`` uses yet."""
    have = {c.lower() for c in df.columns} | {c.lower() for c in taken}
    name = base
    while name.lower() in have:
        name += "_"
    return name
