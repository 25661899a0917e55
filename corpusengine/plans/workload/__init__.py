"""Every operator bound to the tables at hand, with the SQL that must give the same rows."""

from corpusengine.plans.workload import learning, ranking, scoring, texts  # noqa: F401
from corpusengine.plans.workload.registry import ORACLES, QUERIES  # noqa: F401
