"""Corpus files, state files, the point store and scratch tables."""
