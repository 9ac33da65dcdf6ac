"""Ordered levels held as integers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from dryspell.model import BELOW_D2, CLASS_LEVELS, D2


def level_code(label, levels: Sequence[str] = CLASS_LEVELS) -> Column:
    """Ordinal of a label; a label outside ``levels`` gives null."""
    label = F.col(label) if isinstance(label, str) else label
    code = F.lit(None).cast("int")
    for ordinal, name in reversed(list(enumerate(levels))):
        code = F.when(label == name, F.lit(ordinal)).otherwise(code)
    return code


def level_label(code, levels: Sequence[str] = CLASS_LEVELS) -> Column:
    """Label of an ordinal; an ordinal out of range gives null."""
    code = F.col(code) if isinstance(code, str) else code
    return F.get(F.array(*[F.lit(x) for x in levels]), code)


def collapse_levels(code, below: int = D2, into: int = BELOW_D2) -> Column:
    """Merge every ordinal under ``below`` into one; nulls stay null."""
    code = F.col(code) if isinstance(code, str) else code
    return F.when(code < below, F.lit(into)).otherwise(code)
