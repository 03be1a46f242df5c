"""loomtext: a text-corpus analytics engine written for PySpark."""
