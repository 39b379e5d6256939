"""Operators of a training-data pipeline: formatting, mixing, packing, search, dedup, token counts and files, toxicity."""
