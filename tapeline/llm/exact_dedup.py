"""Exact dedup by two-pass Bloom filtering, in DataFrame functions only.

Pass 1 sets two slots for each text's SHA-256 and keeps the slots that more than one row
has hit. Pass 2 probes them: a row with an unshared slot is surely alone and passes straight
through; only the other rows shuffle, with an exact comparison of the SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import join_groups, packed, slot_bits, slots_for, staged, unpacked, with_bit

#: Bits of the broadcast filter: 16 MB. Beyond about 8 million rows more and more single rows shuffle as well; results stay exact.
MAX_SLOTS = 1 << 27
SLOTS_PER_ROW = 16


def _slots(sha: Column, slots: int) -> list[Column]:
    return [F.conv(F.substring(sha, at, 15), 16, 10).cast("long") % slots for at in (1, 17)]


def possible_copies(hashed: DataFrame, sha: str, max_slots: int = MAX_SLOTS) -> tuple[DataFrame, int]:
    """Pass 1 over `hashed`: bitmap of the slots hit by more than one row, and the number of slots."""
    slots = slots_for(hashed.count(), SLOTS_PER_ROW, max_slots)
    hits = hashed.select(F.explode(F.array_distinct(F.array(*_slots(F.col(sha), slots)))).alias("slot"))
    repeated = hits.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return staged(slot_bits(repeated, "slot")), slots


def mark_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_slots: int = MAX_SLOTS) -> DataFrame:
    """All rows of `df` with keep_id, group_size, kept and text_sha256.

    Texts are equal when identical; null counts as empty. Of equal texts the row with the
    largest id stays. Nulls in the id sort below every id; a group of null ids only keeps all
    its rows with keep_id null. Rows that repeat both id and text are one document
    listed twice: they share one verdict and each counts in group_size. Extra columns named
    like an added one give way to it.
    """
    sha = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    rows = packed(df, id_col, text_col).toDF("row", "id", "text").select("row", "id", sha.alias("text_sha256"))
    hashed = staged(rows.select("id", "text_sha256"))
    bits, slots = possible_copies(hashed, "text_sha256", max_slots)
    first, second = _slots(F.col("text_sha256"), slots)

    def probed(frame: DataFrame) -> DataFrame:
        return with_bit(with_bit(frame, bits, first, "hit_1"), bits, second, "hit_2").withColumn("maybe", F.expr("hit_1 and hit_2"))

    candidates = staged(probed(hashed).where("maybe").select("id", "text_sha256"))
    groups = staged(
        candidates.groupBy("text_sha256")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    marked = probed(rows)
    alone = marked.where(~F.col("maybe")).select(
        "row", "id", "text_sha256", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")
    )
    shared = join_groups(
        marked.where("maybe").select("row", "id", "text_sha256"), groups, "text_sha256", "group_size", candidates.count(), "id"
    ).select("row", "id", "text_sha256", "keep_id", "group_size")
    both = alone.unionByName(shared).withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))
    return unpacked(both, df.columns, "keep_id", "group_size", "kept", "text_sha256")


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_slots: int = MAX_SLOTS) -> DataFrame:
    """The rows that stay, one of each text, with the columns of `df`.

    Of rows that share the largest id of their text (or have null ids only), any one stays.
    """
    whole = packed(df, id_col, text_col).toDF("whole", "id", "text")
    staying = mark_copies(whole, "id", "text", max_slots).where("kept")
    # grouped rows only, and tasks pick one of each text before they shuffle
    single = staying.where("group_size = 1").select("whole.*")
    one = staying.where("group_size > 1").groupBy("text_sha256").agg(F.first("whole").alias("whole"))
    return single.unionByName(one.select("whole.*"))
