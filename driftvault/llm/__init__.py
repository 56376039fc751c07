"""Training-data operators: language identification, deduplication, sharding, web archives, tokenising,
quality rules, packing and toxicity. Nothing outside this subpackage imports it."""
