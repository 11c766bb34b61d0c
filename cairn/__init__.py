"""A Spark library for resource inventories, keyspaces, call logs and text corpora."""
