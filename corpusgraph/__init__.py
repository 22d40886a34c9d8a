"""PySpark-native engine for document-release corpora and their knowledge graph."""
