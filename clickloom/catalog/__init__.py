"""Named queries over the given tables, each beside the SQL that defines its result."""
