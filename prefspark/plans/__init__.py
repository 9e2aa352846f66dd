"""Composite jobs (JB1-JB7), the derived fixtures and the registered queries."""
