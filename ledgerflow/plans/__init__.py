"""Warehouse jobs built from the operators: staging, star schema, checks, measures."""
