"""Operators for training corpora, each a function from documents or pages to a DataFrame."""
