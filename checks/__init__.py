"""Queries over the supplied test tables, each with the SQL it is compared against."""
