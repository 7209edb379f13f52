"""Registered queries over the star-schema test tables, with the SQL that checks them."""
