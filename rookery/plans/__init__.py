"""All registered jobs."""

from rookery.plans import feeds, ingest, maps, relational, streams, texts, upkeep  # noqa: F401
from rookery.plans.registry import JOBS  # noqa: F401
