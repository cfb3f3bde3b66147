"""Composite jobs: bronze, silver, gold, train, score, monitor."""
