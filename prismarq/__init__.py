"""A PySpark-native engine for image-enrichment datasets."""
