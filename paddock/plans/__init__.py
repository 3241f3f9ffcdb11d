"""Jobs built from operators, and the registered queries."""
