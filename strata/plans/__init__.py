"""Layer jobs and the registered queries."""
