"""The registered queries of the engine and the SQL each of them is checked against."""
