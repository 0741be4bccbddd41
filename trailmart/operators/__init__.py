"""DataFrame to DataFrame functions; none of them reads or writes a table."""
