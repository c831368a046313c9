"""All registered queries."""

from tillsight.workload import composite, models, recommendations, relational, texts  # noqa: F401
from tillsight.workload.registry import ORACLE, QUERIES  # noqa: F401
