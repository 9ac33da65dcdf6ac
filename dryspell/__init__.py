"""Drought-run eligibility analytics as plain Spark plans.

The package turns weekly, per-unit drought classes into dated and scored eligibility events. Every
operator takes and returns a DataFrame; nothing in the core runs Python code on rows.
"""

from dryspell.plans.determine import determine
from dryspell.plans.ingest import ingest
from dryspell.plans.publish import publish

__all__ = ["determine", "ingest", "publish"]
