"""pairforge: sentence-pair corpus preparation, tokenization, batching,
decoding and evaluation expressed as Spark DataFrame jobs."""

__version__ = "0.1.0"
