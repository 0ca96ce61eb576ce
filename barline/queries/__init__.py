"""All registered queries, by section; importing this fills the registry."""

from barline.queries import (  # noqa: F401
    checks, models, scalars, scans, strategies, streams, tables, windows,
)
from barline.queries.registry import REGISTRY  # noqa: F401
