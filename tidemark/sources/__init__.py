"""Sources: canonical schemas, readers, and adapters from the driver tables."""

from tidemark.sources.adapters import (  # noqa: F401
    canonical_customers,
    events_transactions,
    lineitem_transactions,
    load_canonical,
    order_transactions,
)
from tidemark.sources.io import read_table, write_table  # noqa: F401
from tidemark.sources.schema import CUSTOMER_SCHEMA, TRANSACTION_SCHEMA  # noqa: F401
