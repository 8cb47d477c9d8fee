"""Training-data operators: dedup, search, extraction, filtering, mixing, tokens, language model."""
