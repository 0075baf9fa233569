"""Curation of labelled, text-heavy ticket tables as plain Spark jobs."""
