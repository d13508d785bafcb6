"""DataFrame operators, one module a stage."""
