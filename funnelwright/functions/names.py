"""Column-name styles of the landed feeds."""

from __future__ import annotations

import re

# For each style, the replacements in the order they apply.
STYLES = {
    "report": [(r"[^a-zA-Z0-9]+", "_")],
    "contact": [(r"[\s\-]+", "_"), (r"[^a-zA-Z0-9_]", ""), (r"^(?=\d)", "_")],
    "snake": [(r"[.\-]", "_"), (r"(?<!^)(?=[A-Z])", "_"), (r"__+", "_")],
}


def clean_name(name: str, style: str) -> str:
    """``name`` in one of the styles ``report``, ``contact`` or ``snake``, lower case."""
    text = name.strip() if style == "report" else name
    for pattern, replacement in STYLES[style]:
        text = re.sub(pattern, replacement, text)
    return text.lower()
