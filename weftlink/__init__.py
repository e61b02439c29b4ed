"""weftlink: a PySpark-native record-linkage and corpus engine."""
