"""The registered queries: each runs an operator over whole tables, with SQL that must agree."""
