"""End-to-end jobs, the query registry and the SQL oracle."""
