"""Operators of a training-data pipeline on document, page and vector tables. Nothing else imports this subpackage."""
