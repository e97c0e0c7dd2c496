"""Plans that put operators together, and the queries over the test tables."""
