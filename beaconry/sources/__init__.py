"""Reading and writing of partitioned tables, text files and key-value rows."""
