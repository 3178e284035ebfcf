"""Posting analytics on Spark: from nested job postings to one clean table and its quality figures."""
