from candlewick.sources.tables import read_table
from candlewick.sources.fixtures import trades_from_events
from candlewick.sources.instruments import instruments

__all__ = ["read_table", "trades_from_events", "instruments"]
