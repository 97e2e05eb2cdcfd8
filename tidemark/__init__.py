"""tidemark: a PySpark-native engine for watch histories and text corpora."""
