"""loomstead: a Spark-first engine for versioned, deduplicated discussion corpora and their annotations."""

__version__ = "0.1.0"
