"""Training-data operators: sharding, chat formatting, near-duplicates, quality, licences, URLs, tokens, language,
packing and nearest neighbours. Nothing outside this subpackage imports it."""
