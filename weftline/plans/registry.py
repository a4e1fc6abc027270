"""All registered queries and their SQL."""

from __future__ import annotations

from . import cleaning, evaluating, forms, merging, tracking

QUERIES = {**merging.QUERIES, **cleaning.QUERIES, **tracking.QUERIES, **evaluating.QUERIES, **forms.QUERIES}
ORACLES = {**merging.ORACLES, **cleaning.ORACLES, **tracking.ORACLES, **evaluating.ORACLES, **forms.ORACLES}
