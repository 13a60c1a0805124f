"""decidra: a PySpark engine for building, auditing and scoring decision datasets."""
