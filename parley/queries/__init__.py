"""All registered queries with their SQL twins."""

from __future__ import annotations

from parley.queries import (
    assembly,
    cleaning,
    dialogue,
    evaluation,
    files,
    retrieval,
    streams,
    vectors,
)

_MODULES = (dialogue, cleaning, assembly, vectors, retrieval, evaluation, streams, files)

QUERIES = {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
