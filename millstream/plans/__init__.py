"""Worked jobs built from the operators, and the queries that bind them to tables."""
