"""Named queries: what to run over a folder of tables, each with the SQL that an independent engine runs for comparison."""
