"""Training-data operators: quality rules, packing, mixing, chat parsing, LM
scoring, token files, near and exact dedup, language id, HTML extraction."""
