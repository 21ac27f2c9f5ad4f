"""Driver queries: every operator run over the given tables, with its SQL check."""

from queries.registry import oracles, runners

# Importing a module registers its queries.
from queries import audits, curated, joins, layers, projections, scans, upserts  # noqa: E402,F401,I001

__all__ = ["oracles", "runners"]
