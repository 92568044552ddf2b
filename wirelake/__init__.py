"""wirelake: news-wire ingestion and text analytics as Spark DataFrame transforms."""

__all__ = ["session"]
