"""Readers and writers: pages, corpora, the language dimension and the test tables."""
