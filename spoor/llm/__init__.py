"""Training-data operators: near-duplicates, tokenising, language, urls, shards, chat, mixing, search, quality, secrets."""
