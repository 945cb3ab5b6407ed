"""carrel: a PySpark engine for clinical-registry abstraction, validation and scoring."""
