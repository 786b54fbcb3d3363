"""End-to-end jobs and the relations derived from the test tables."""
