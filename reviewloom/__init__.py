"""reviewloom: customer-review enrichment as Spark DataFrame pipelines."""

__version__ = "0.1.0"
