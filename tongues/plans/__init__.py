"""Whole jobs: building a corpus, training a detector, scoring a test suite."""
