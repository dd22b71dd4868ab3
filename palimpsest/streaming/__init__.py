"""Revisions as a stream: newly landed history tables, judged page by page as they come."""
