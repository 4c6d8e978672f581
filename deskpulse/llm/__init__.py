"""Training-data operators: near-duplicates, formatting, private data, tokens,
secrets, toxicity, quality, URL rules and benchmark decontamination.

Nothing else in the library imports this subpackage.
"""
