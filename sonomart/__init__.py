"""sonomart: a listening-history star warehouse and OLAP layer built from Spark DataFrames."""
