"""Whether two tables hold the same rows, as often, in whatever order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of a hash that are summed together.
PIECE = 16


def multiset_digest(columns: list[str]) -> dict[str, Column]:
    """Aggregates `rows`, `sum_1` and `sum_2` that depend on the rows but not on their order.

    Two hashes of every row are summed, so digests of parts add up to the digest of the
    whole. Which columns are NULL is hashed too, as hashes pass over NULLs. Hashes are summed in
    four pieces of 16 bits, as whole numbers: decimals would be objects, two a row. That holds
    some 10**14 rows.
    """
    values = [F.col(c) for c in columns] + [F.col(c).isNull() for c in columns]

    def total(*hashed: Column) -> Column:
        rest, found = F.xxhash64(*hashed), F.lit(0).cast("decimal(38,0)")
        for k in range(4):
            piece = F.shiftright(rest, PIECE * k)
            if k < 3:  # the last one keeps the sign
                piece = piece.bitwiseAND(F.lit(2 ** PIECE - 1))
            found += F.sum(piece).cast("decimal(38,0)") * F.lit(2 ** (PIECE * k)).cast("decimal(20,0)")
        return F.coalesce(found.cast("decimal(38,0)"), F.lit(0))

    return {"rows": F.count(F.lit(1)), "sum_1": total(*values), "sum_2": total(F.lit(1), *values)}
