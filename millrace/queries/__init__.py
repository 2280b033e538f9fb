"""The registered queries: operators bound to the input tables, with their SQL twins.

A query whose result SQL can state has a twin; the others (fitted models,
hashed features) are checked by invariants in the tests.
"""

from millrace.queries import (  # noqa: F401
    aggregates,
    features,
    joins,
    models,
    quality,
    relational,
    scalars,
    sources,
    streams,
    text,
    windows,
)
