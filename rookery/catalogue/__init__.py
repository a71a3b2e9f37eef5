"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from .cases import QUERIES as _CASES
from .cases import SQL as _CASES_SQL
from .domain import QUERIES as _DOMAIN
from .domain import SQL as _DOMAIN_SQL
from .fields import QUERIES as _FIELDS
from .fields import SQL as _FIELDS_SQL
from .planning import QUERIES as _PLANNING
from .planning import SQL as _PLANNING_SQL
from .rounds import QUERIES as _ROUNDS
from .rounds import SQL as _ROUNDS_SQL
from .tables import QUERIES as _TABLES
from .tables import SQL as _TABLES_SQL

QUERIES: dict = _DOMAIN | _FIELDS | _PLANNING | _CASES | _TABLES | _ROUNDS
SQL: dict = _DOMAIN_SQL | _FIELDS_SQL | _PLANNING_SQL | _CASES_SQL | _TABLES_SQL | _ROUNDS_SQL
