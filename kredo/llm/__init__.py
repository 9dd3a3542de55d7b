"""Training-data operators: sharding, decontamination, packing, PII, WARC derivatives, near-duplicates,
quality, token stores and language identification.  Nothing else in the library imports this package."""
