"""Training-data operators: formatting, deduplication, filtering, mixing, packing and counting."""
