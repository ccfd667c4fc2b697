"""The registered queries and their check SQL."""
