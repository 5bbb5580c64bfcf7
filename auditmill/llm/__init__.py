"""Operators of a training-data pipeline: scoring, filtering, deduplication, tokenizing, packing, archives, chat."""
