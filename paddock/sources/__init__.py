"""Reading and writing listing tables, rates, pages and run outputs."""
