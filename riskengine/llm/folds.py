"""Which documents a model may learn from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FOLDS = 4
HELD_OUT = 2


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning: CRC-32 of its id as text, modulo 4, is 2. A null id is not
    held out, and nothing is learned from it either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def learnable(doc_id: str = "doc_id") -> Column:
    return F.col(doc_id).isNotNull() & ~held_out(doc_id)


def chance(column: str, seed: int) -> Column:
    """A number in [0, 1) that a column's value and a seed give, the same in every run."""
    return F.pmod(F.xxhash64(F.col(column).cast("string"), F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
