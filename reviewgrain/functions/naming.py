"""Column-name rules, applied while the plan is built."""

from __future__ import annotations

import re
from collections.abc import Mapping

from reviewgrain import lexicons as lx


def snake_case(name: str) -> str:
    """``ReviewUpvotes`` / ``with spaces`` -> ``review_upvotes`` / ``with_spaces``."""
    text = name.replace(" ", " ").strip()
    for boundary in (r"(?<=.)(?=[A-Z][a-z])", r"(?<=[a-z0-9])(?=[A-Z])"):
        text = re.sub(boundary, "_", text)
    return re.sub(r"[^0-9A-Za-z]+", "_", text).strip("_").lower()


def normalise_name(name: str, renames: Mapping[str, str] = lx.COLUMN_RENAMES) -> str:
    """Known spellings such as ``uniq _id`` first, snake case for everything else."""
    text = " ".join(str(name).replace(" ", " ").split())
    return renames[text] if text in renames else snake_case(text)
