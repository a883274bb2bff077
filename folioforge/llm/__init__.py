"""Operators for text that goes into language models."""
