"""Join-key coercion.

The dimension key is BIGINT, the fact key is text.  Comparing as text would
lose ``'010'`` = 10 and ``' 11 '`` = 11, so the text is cast to BIGINT once,
on the fact side, before the join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def numeric_key(text: Column | str, *, strict: bool = False) -> Column:
    """Text key -> BIGINT.  Tolerant: non-numbers become NULL (never match).
    Strict: a non-NULL non-number fails the query, whatever the ANSI mode.

    Surrounding whitespace, a sign and leading zeros are accepted; decimals
    (``'1.5'``), exponents, hex and digit separators are not numbers here, and
    neither is anything beyond the BIGINT range.
    """
    c = F.col(text) if isinstance(text, str) else text
    key = c.try_cast("bigint")
    if not strict:
        return key
    bad = c.isNotNull() & key.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("join key is not a number: "), c))).otherwise(key)
