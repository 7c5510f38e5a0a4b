"""Operators for preparing training text at scale, apart from the commerce feeds.

Nothing outside this folder imports it. ``queries.py`` registers one query per
operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
