"""Operators for preparing training data: URL filters, deduplication,
tokenisation, decontamination, classifiers, extraction, secrets and language
models.  Nothing else in the library imports this subpackage."""
