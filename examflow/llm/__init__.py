"""Operators for text corpora that train language models. Nothing outside this package imports it."""
