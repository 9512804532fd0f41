"""catalith: PySpark-native processing of captured product catalogues and their texts."""
