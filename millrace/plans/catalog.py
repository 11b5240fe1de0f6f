"""All registered queries; importing a module registers its queries."""

from millrace.plans import (
    bronze_queries,
    cdc_queries,
    event_queries,
    ingest_queries,
    metric_queries,
    silver_queries,
)
from millrace.plans.registry import CHECKS, QUERIES
