"""Keys made from row numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

def vehicle_id(i: Column) -> Column:
    """Key of the ``i``-th (0-based) vehicle: three letters, then four hex digits."""
    block = F.floor(i / F.lit(16**4).cast("decimal(6,0)")).cast("bigint")
    letters = [
        F.chr((F.pmod(F.floor(block / F.lit(26**place).cast("decimal(4,0)")), F.lit(26)) + 65).cast("bigint"))
        for place in (2, 1, 0)
    ]
    return F.concat(*letters, F.lpad(F.hex(F.pmod(i, F.lit(16**4))), 4, "0"))
