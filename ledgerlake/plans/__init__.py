"""Composite models: silver, gold, contracts, ingest bookkeeping."""
from . import contracts, gold, ingest, silver
