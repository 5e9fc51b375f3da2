"""millrace: ingest, shape and vet tables and streams with plain Spark plans."""

__version__ = "0.1.0"
