"""Named queries: every operator bound to the star-schema, event, document and vector tables."""

from . import (aggregates, cleansing, expressions, joins, learning, ordering, sources,  # noqa: F401
               spatial, streams, textual)
from .registry import CHECK_SQL, QUERIES  # noqa: F401
