"""Training-data operators: dedup, sharding, scoring, language, quality, BPE,
privacy, fingerprints and mixing. Nothing outside this subpackage imports it."""
