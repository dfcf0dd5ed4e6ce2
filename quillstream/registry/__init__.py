"""Named queries over the test tables, with SQL that states the same results."""
