"""Whole reports, and the queries that check every operator on the test tables."""
