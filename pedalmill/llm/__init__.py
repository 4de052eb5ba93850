"""Operators for building training corpora from raw text, and their registered queries."""
