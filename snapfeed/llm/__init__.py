"""Operators of a training-data pipeline: extraction, rules, counts, copies, chats, mixing.

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
