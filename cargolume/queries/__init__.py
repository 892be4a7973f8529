"""All registered queries."""

from cargolume.queries import allocation_queries, formula_queries, job_queries, metric_queries, star_queries, verdict_queries
from cargolume.queries.base import REGISTRY

__all__ = ["REGISTRY", "allocation_queries", "formula_queries", "job_queries", "metric_queries", "star_queries", "verdict_queries"]
