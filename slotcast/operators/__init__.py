"""DataFrame operators: each takes a DataFrame and returns a lazy DataFrame or a small fitted record."""
