"""All registered queries. Importing this package fills the registry."""

from . import chains, files, joining, modelling, quality, series, streams, summaries  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
