"""Shelfmark: catalogue matching and corpus preparation as Spark jobs."""
