"""Operators: silver, gold, serving, profiling, enrichment, analyses and ordering helpers."""
