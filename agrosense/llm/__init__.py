"""Operators that prepare a text corpus for training (see README, "Corpus operators").

Nothing outside this folder imports it; ``corpus_pipeline.py`` at the repository top and
``__spark_entry__.py`` use it.
"""
