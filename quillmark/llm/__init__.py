"""Training-data operators: sharding, mixing, language, contamination, copies, pages, secrets, toxicity, quality."""
