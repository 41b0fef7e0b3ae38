"""Operators of a training-data pipeline: quality, mixing, copies, toxicity, language model, token ids."""
