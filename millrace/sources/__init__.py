"""Reading and writing files, partitioned tables, JDBC tables and workbooks."""
