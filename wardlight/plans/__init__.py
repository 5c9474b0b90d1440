"""Jobs that chain operators, and the queries over the test tables."""
