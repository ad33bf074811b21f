"""All check statements by query name."""

from __future__ import annotations

from oracle.tables import TABLES
from oracle.views import VIEWS

STATEMENTS = {**VIEWS, **TABLES}
