"""Registered queries over the test tables and the SQL each one must agree with."""
