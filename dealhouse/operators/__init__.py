"""Relational operators: staging pipelines, quarantine split, SCD1 merge,
partition replace, column evolution, data-quality checks."""
