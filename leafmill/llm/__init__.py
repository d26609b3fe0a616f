"""Training-data operators: packing, scans, dedup, decontamination, scoring, search, sharding."""
