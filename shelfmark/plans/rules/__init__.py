"""The consistency rules. Importing this package fills the registry."""

from . import credits, downloads, entries, magazines, notes, origins, relations, tags  # noqa: F401
from .registry import REGISTRY, Rule, read_findings, run_checks, run_rule, sorted_findings, store_findings

__all__ = ["REGISTRY", "Rule", "read_findings", "run_checks", "run_rule", "sorted_findings", "store_findings"]
