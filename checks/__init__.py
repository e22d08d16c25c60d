"""The operators run over the test tables, and the SQL each result must equal."""
