"""Training-data pipeline operators: language id, URL policy, dedup, tokens, mixing, shards, search, quality."""
