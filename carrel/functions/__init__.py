"""Part of the carrel registry engine."""
