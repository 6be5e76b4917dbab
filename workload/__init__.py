"""The registered queries: operators bound to the test tables, and their SQL."""
