"""Importing this package registers every query module."""

from tessera.plans import (  # noqa: F401
    q_aggregates, q_banking, q_changes, q_joins, q_relational, q_streaming, q_views,
)
