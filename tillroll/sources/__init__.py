"""Table sources (testdata adapters, declared schemas) and sinks."""

from tillroll.sources.tables import LoyaltyTables, DeliveryTables  # noqa: F401
