"""Preparing training data for language models: one module per operator, queries in ``queries``."""
