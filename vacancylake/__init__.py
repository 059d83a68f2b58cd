"""Vacancy postings as Spark jobs: extract, clean, upsert, enrich, report."""
