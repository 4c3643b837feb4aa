"""Plan shapes shared by operators, whole jobs, and the bindings to the test tables."""
