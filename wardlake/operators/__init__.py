"""Relational building blocks: dedupe, merge, joins safe against hot keys, vector top-k."""

from wardlake.operators.dedupe import latest_per_key  # noqa: F401
from wardlake.operators.joins import join_unique  # noqa: F401
from wardlake.operators.merge import live_rows, merge_changes  # noqa: F401
