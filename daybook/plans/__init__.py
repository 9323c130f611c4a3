"""End-to-end jobs, registered queries and their SQL oracles, plan checks."""
