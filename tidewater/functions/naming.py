"""Column-name rules (pure Python on schema names, never on data)."""

from __future__ import annotations

import re
import string

WORD_START = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=.)(?=[A-Z][a-z])")
KEY_CHARACTERS = frozenset(string.ascii_lowercase + string.digits)
IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def to_snake_case(name: str) -> str:
    """camelCase / PascalCase to snake_case: ``updatedAt`` -> ``updated_at``,
    ``HTTPServer`` -> ``http_server``. A word begins at a capital that follows
    a small letter or digit, or that a small letter follows."""
    return "_".join(WORD_START.split(name)).lower()


def column_key(name: str) -> str:
    """Loose match key: lower case, alphanumerics only (``updated_at`` and
    ``updatedAt`` share the key ``updatedat``)."""
    return "".join(filter(KEY_CHARACTERS.__contains__, name.lower()))


def validate_identifier(name: str, what: str = "identifier") -> str:
    if not IDENTIFIER.match(name or ""):
        raise ValueError(f"invalid {what}: {name!r}")
    return name
