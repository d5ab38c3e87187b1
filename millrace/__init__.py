"""millrace — supply-chain and sales analytics as Spark DataFrame / SQL / Structured Streaming jobs."""

__version__ = "0.1.0"
