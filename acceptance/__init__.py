"""Queries over the given star-schema tables, with the SQL that must agree with them."""
