"""enrichlake: company and people enrichment as Spark DataFrame jobs."""

__version__ = "0.1.0"
