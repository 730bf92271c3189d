"""Check queries: the library on the supplied tables, each with the same result stated in SQL."""
