"""DataFrame operators: tables and an explicit point in time in, a DataFrame out."""
