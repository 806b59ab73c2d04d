"""Registered queries over the analytics tables, each with its SQL twin where SQL can say it."""

from churnkit.plans import columns, evaluation, joins, models, monitoring, profiling, requests, storage, streams  # noqa: F401
from churnkit.plans.registry import QUERIES, SQL  # noqa: F401
