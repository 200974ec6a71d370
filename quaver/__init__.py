"""quaver: a PySpark-native engine for building and auditing event-sequence corpora."""
