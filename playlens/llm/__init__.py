"""Training-data operators: tokens, shards, quality, near copies, repeats, leaks."""
