"""The registered queries, each with the SQL that states its expected result."""
