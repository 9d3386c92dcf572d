"""All registered queries; importing a module registers its queries."""

from lexlake.catalog import (  # noqa: F401
    landing,
    monitors,
    projections,
    quality,
    reporting,
    state,
    stored,
    validation,
)
