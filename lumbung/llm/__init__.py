"""Operators for large text corpora: token counts, mixing, language, URLs, near copies, quality, archives, toxicity, leaks, repeats."""
