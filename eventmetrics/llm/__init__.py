"""Operators for training-data corpora: one module for each, and their queries in `queries`."""
