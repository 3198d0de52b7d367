"""Cells out of raw HTML text: list items by position, and data tables picked by their shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Header cells and sizes that identify the two data tables, cell positions taken.
CONSENSUS_HEADERS = ("3 Months Ago", "1 Month Ago")
CONSENSUS_CELLS, CONSENSUS_TAKEN = 15, (2, 5, 8, 11, 14)
VALUE_CELLS, VALUE_TAKEN = 5, (0, 1, 2, 3, 4)


def elements(html: Column, tag: str) -> Column:
    """Inner HTML of every `tag` element."""
    return F.regexp_extract_all(html, F.lit(rf"(?s)<{tag}[^>]*>(.*?)</{tag}>"), F.lit(1))


def by_class(html: Column, name: str) -> Column:
    """Inner text of every table cell that carries a class."""
    return F.regexp_extract_all(html, F.lit(rf'(?s)<t[dh][^>]*class="[^"]*\b{name}\b[^"]*"[^>]*>(.*?)</t[dh]>'), F.lit(1))


def bare(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "<[^>]*>", ""))


def page_cells(pages: DataFrame, tag: str, positions: list[int]) -> DataFrame:
    """Text of the elements at 1-based positions; a missing one is ''."""
    texts = F.transform(elements(F.col("html"), tag), bare)
    cells = [F.coalesce(F.get("_x", F.lit(p - 1)), F.lit("")).alias(f"cell{i}") for i, p in enumerate(positions, 1)]
    return pages.select("page_id", texts.alias("_x")).select("page_id", *cells, F.size("_x").cast("long").alias("n"))


def _pick(tables: Column, test, taken: tuple[int, ...]) -> Column:
    """Cells of the first table that passes the test, or blanks."""
    found = F.get(F.filter(tables, test), F.lit(0))
    cells = by_class(found, "data_data")
    return F.array(*[F.coalesce(bare(F.get(cells, F.lit(i))), F.lit("")) for i in taken])


def page_tables(pages: DataFrame) -> DataFrame:
    """Ten cells per page: five ratings of the consensus table and five price targets.

    The consensus table has a head, the two month headers and fifteen data cells; the value
    table has no head, five labels and five data cells.
    """
    tables = F.regexp_extract_all("html", F.lit(r'(?s)<table[^>]*class="[^"]*cr_dataTable[^"]*"[^>]*>(.*?)</table>'), F.lit(1))

    def consensus(t: Column) -> Column:
        heads = F.transform(elements(t, "th"), bare)
        return (
            t.contains("<thead")
            & (F.size(heads) > 2)
            & (F.get(heads, F.lit(1)) == CONSENSUS_HEADERS[0])
            & (F.get(heads, F.lit(2)) == CONSENSUS_HEADERS[1])
            & (F.size(by_class(t, "data_data")) == CONSENSUS_CELLS)
        )

    def value(t: Column) -> Column:
        return ~t.contains("<thead") & (F.size(by_class(t, "data_lbl")) == VALUE_CELLS) & (F.size(by_class(t, "data_data")) == VALUE_CELLS)

    picked = pages.select("page_id", tables.alias("_t")).select(
        "page_id", _pick(F.col("_t"), consensus, CONSENSUS_TAKEN).alias("_c"), _pick(F.col("_t"), value, VALUE_TAKEN).alias("_v")
    )
    names = ("buy", "overweight", "hold", "underweight", "sell"), ("high", "median", "low", "average", "current")
    return picked.select(
        "page_id",
        *[F.get("_c", F.lit(i)).alias(n) for i, n in enumerate(names[0])],
        *[F.get("_v", F.lit(i)).alias(n) for i, n in enumerate(names[1])],
    )
