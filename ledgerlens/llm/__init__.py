"""Operators for preparing large training corpora, one module each."""
