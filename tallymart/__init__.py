"""PySpark engine for cross-source price comparison and corpus preparation."""
