"""newsvane: news-sentiment and market-signal analytics as Spark jobs."""

__version__ = "0.1.0"
