"""Loading CSV files and reading and writing the tables of a layer."""
