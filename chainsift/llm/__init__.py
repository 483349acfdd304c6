"""Training-data operators: token counts, near-duplicates, PII, quality, sharding,
decontamination, fingerprints, WARC, BPE and set-similarity joins, each a Spark job."""
