"""Training-data operators: quality, toxicity, mixing, deduplication, decontamination,
token output, extraction.  Nothing outside this subpackage imports it."""
