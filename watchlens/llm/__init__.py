"""Operators for preparing training corpora, with the queries that apply them."""
