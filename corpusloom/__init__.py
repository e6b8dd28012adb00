"""A PySpark-native engine for curating and analysing text and conversation corpora."""
