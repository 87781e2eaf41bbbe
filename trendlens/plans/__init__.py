"""The registered queries over the star tables, and the SQL they must agree with."""
