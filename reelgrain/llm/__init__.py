"""Operators that prepare text and event data for training language models."""
