"""The three workloads, the stand-in views over the test tables, and the registered queries."""
