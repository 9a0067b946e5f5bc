"""Training-data operators: filters, deduplication, scoring, formatting, packing and web archives."""
