"""Imports every catalog module so their queries register."""

from cellcast.plans import catalog  # noqa: F401
from cellcast.plans import catalog_metrics  # noqa: F401

QUERIES = catalog.QUERIES
ORACLE_SQL = catalog.ORACLE_SQL
from cellcast.plans import catalog_history  # noqa: F401,E402
from cellcast.plans import catalog_spatial  # noqa: F401,E402
from cellcast.plans import catalog_io  # noqa: F401,E402
from cellcast.plans import catalog_functions  # noqa: F401,E402
from cellcast.plans import catalog_contracts  # noqa: F401,E402
