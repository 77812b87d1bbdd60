"""Training-data operators: encoding, decontamination, dedup, packing, formatting,
similarity joins, sharding, extraction and quality rules. Nothing else in the
library imports this subpackage."""
