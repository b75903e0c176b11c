"""Named queries over the test tables, each with the SQL that checks it."""

from tidemark.plans import (  # noqa: F401
    drift,
    governance,
    ingest,
    metrics,
    models,
    prepare,
    serving,
    streams,
    summaries,
)
from tidemark.plans.registry import ORACLES, QUERIES  # noqa: F401
