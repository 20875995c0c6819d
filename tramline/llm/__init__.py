"""Operators that prepare text corpora for model training, and their queries."""
