"""Named queries over the tables at hand, each with the SQL that must give the same rows."""
