"""Relational operators: matching joins, write-back, clustering, fills, reports."""
