"""Relational operators: upsert, versions, joins, references, quarantine."""
