"""Multi-table jobs and reader queries."""
