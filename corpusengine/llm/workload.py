"""All queries of the package."""

from corpusengine.llm import alignment, audit, bytepair, collocations, lattice, minhash, packing, passages, ranking, records, rules, weighting, wrapper  # noqa: F401
from corpusengine.llm.registry import ORACLES, QUERIES  # noqa: F401
