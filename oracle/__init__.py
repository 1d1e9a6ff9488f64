"""Reference answers in DuckDB SQL, written independently of the Spark plans."""

from __future__ import annotations

import re

from shelfmark.fixtures.derived import DEFINITIONS, oracle_cte


def over_catalogue(select: str) -> str:
    """Prefix a select with the derived tables it names as ``cat_<table>``."""
    used = set(re.findall(r"\bcat_(\w+)", select))
    return f"{oracle_cte([n for n in DEFINITIONS if n in used])}\n{select}"
