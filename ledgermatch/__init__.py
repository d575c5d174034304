"""ledgermatch: supplier-payment consolidation and register matching on Spark."""

__version__ = "0.1.0"
