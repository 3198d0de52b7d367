"""Entity-attribute-value-time rows with a JSON value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.functions.text import finite, quote_bare_numbers

# The statistics of a `_basic` row.
STATISTICS = (
    "average", "variance", "minimum", "pop_var", "maximum", "sum_log", "sum_sqr", "geo_avg", "fst_qrt", "lst_qrt", "lst_pct", "fst_pct",
)
COEFFICIENTS = ("zero", "first", "second")


def eavt_basic(eavt: DataFrame) -> DataFrame:
    """Twelve statistics of every `_basic` attribute; NaN and infinities become NULL."""
    fields = F.from_json(quote_bare_numbers(F.col("valu")), ", ".join(f"{s} string" for s in STATISTICS))
    rows = eavt.where(F.col("attrib").endswith("_basic")).withColumn("_j", fields)
    return rows.select("entity", F.col("dindex").alias("date_index"), "attrib", *[finite(F.col(f"_j.{s}")).alias(s) for s in STATISTICS])


def eavt_curve(eavt: DataFrame) -> DataFrame:
    """Up to three coefficients of every `_linear` or `_quadratic` attribute."""
    rows = eavt.where(F.col("attrib").endswith("_linear") | F.col("attrib").endswith("_quadratic"))
    rows = rows.withColumn("_j", F.from_json("valu", "array<string>"))
    return rows.select(
        "entity", F.col("dindex").alias("date_index"), "attrib", *[finite(F.get("_j", F.lit(i))).alias(c) for i, c in enumerate(COEFFICIENTS)]
    )
