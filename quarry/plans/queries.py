"""All registered queries (importing the modules fills the registry)."""

from quarry.plans import q_functions, q_io, q_joins, q_profile, q_regression, q_relational, q_schema, q_semistructured  # noqa: F401
from quarry.plans.registry import REGISTRY, QuerySpec  # noqa: F401
