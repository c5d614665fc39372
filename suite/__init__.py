"""Checked queries: every operator run on the supplied tables, next to equivalent SQL."""
