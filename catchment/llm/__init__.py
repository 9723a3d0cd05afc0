"""Operators for preparing training data: sharding, quality filtering,
deduplication, mixing, tokenising, packing, language-model scoring, vector
search and URL rules. Nothing else in the library imports this package."""
