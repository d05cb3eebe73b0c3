"""Messages derived from the test tables, the queries over them, and the same queries in plain SQL."""
