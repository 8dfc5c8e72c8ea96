"""Full-text search and tabular ingest as Spark jobs."""

from findery import runtime
from findery.plans.index import TextIndex, append, build, upsert
from findery.plans.search import (
    attach_stored,
    search_boolean,
    search_fuzzy,
    search_keywords,
    search_phrase,
    search_prefix,
    search_term,
    search_wildcard,
    total_hits,
)
from findery.plans.store import IndexStore

__all__ = [
    "IndexStore",
    "TextIndex",
    "append",
    "attach_stored",
    "build",
    "search_boolean",
    "search_fuzzy",
    "search_keywords",
    "search_phrase",
    "search_prefix",
    "search_term",
    "search_wildcard",
    "runtime",
    "total_hits",
    "upsert",
]
