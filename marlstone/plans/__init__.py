"""Registered queries, one module per group of operators."""

from marlstone.plans import registry


def load() -> dict[str, registry.Query]:
    from marlstone.plans import (  # noqa: F401
        features,
        models,
        monitoring,
        relational,
        retrieval,
        sources,
        streams,
        tables,
        text,
        vectors,
    )

    return registry.QUERIES
