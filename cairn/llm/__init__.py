"""Training-data operators: dedup, tokenising, scoring, scanning and packing of text corpora on Spark."""
