"""The registered queries: each module adds its own to ``queries.QUERIES`` and ``queries.SQL``."""

from . import jobs, queries, stateful, store  # noqa: F401
