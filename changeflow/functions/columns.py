"""Column expressions shared by the operators. All of them stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"
# Net effect of "deleted, then written again" over several batches. It only arises inside
# a replay, so it carries a name that no source feed uses.
REPLACE = "__replace__"

CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIMESTAMP = "_change_type", "_commit_version", "_commit_timestamp"

# Fixed values of the keyed sample: row is in when ((key mod M) * A + B) mod M < rate * M.
SAMPLE_A, SAMPLE_B, SAMPLE_M = 7919, 104729, 1000003


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def any_null(names: Sequence[str]) -> Column:
    cond = F.col(names[0]).isNull()
    for name in names[1:]:
        cond = cond | F.col(name).isNull()
    return cond


def op_rank(op: Column) -> Column:
    """Order of operations that tie on everything else: DELETE over UPDATE over INSERT."""
    return F.when(op == DELETE, 3).when(op == UPDATE, 2).when(op == INSERT, 1).otherwise(0)


def scale_and_round(name: str, factor: float, type_name: str) -> Column:
    """Multiply; integers are rounded half to even; the column keeps its type."""
    scaled = F.col(name) * F.lit(factor)
    if type_name in ("tinyint", "smallint", "int", "bigint"):
        scaled = F.rint(scaled)
    return scaled.cast(type_name)


def as_timestamp(text: Column) -> Column:
    """Date text as a zone-free timestamp, NULL when it does not parse."""
    return text.try_cast("timestamp_ntz")


def _second_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; a cast leaves zone-free times alone, unlike ``date_format``."""
    return F.substring(ts.cast("string"), 1, 19)


def file_stamp(ts: Column) -> Column:
    """Timestamp text used in the names of landed data: ``yyyyMMdd_HHmmss``."""
    return F.translate(_second_text(ts), " -:", "_")


def iso_text(ts: Column) -> Column:
    """ISO time text with the fraction of the second, where there is one; such texts sort as their times do."""
    return F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))


def in_sample(key: Column, rate: float) -> Column:
    """Repeatable sample of integer keys at ``rate``; the same keys on every run."""
    spread = F.pmod(F.pmod(key, F.lit(SAMPLE_M)) * SAMPLE_A + SAMPLE_B, F.lit(SAMPLE_M))
    return spread < F.lit(int(rate * SAMPLE_M))
