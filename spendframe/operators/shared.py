"""One read for several branches of a plan.

Catalyst prunes and filters every branch of a plan by itself, so two readers of one DataFrame end in
two scans.  Branches whose plans agree up to an exchange share it.  These helpers make them agree:

* ``kept`` for an aggregate: a filter that is always true on the named columns, so all readers
  need the same columns of it and the exchange below it is one;
* ``shared`` for rows: they are dealt out once by an exchange of their own, and a filter that
  cannot sink (it holds ``rand``) keeps what readers drop or ask for above that exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = -(1 << 63)


def kept(df: DataFrame, columns: Sequence[str], apart: bool = False) -> DataFrame:
    """``df``, with ``columns`` needed by whatever reads it; with ``apart``, readers' filters on its
    grouping columns stay above it too."""
    held = F.xxhash64(*columns)
    # a comparison of rand alone with a constant is folded away
    return df.where(held.cast("double") + F.rand(0) >= 2.0 * LEAST if apart else held >= F.lit(LEAST))


def shared(df: DataFrame) -> DataFrame:
    """``df``, dealt out by its rows' hash, for several readers in one plan."""
    dealt = df.repartition(*df.columns)
    return dealt.where((F.xxhash64(*df.columns) >= F.lit(LEAST)) & (F.rand(0) >= 0))
