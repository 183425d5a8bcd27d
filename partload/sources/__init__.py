"""Reading and writing: tables, delimited text, JDBC, the catalog and the file system."""
