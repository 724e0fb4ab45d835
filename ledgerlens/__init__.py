"""Card-transaction analytics and fraud scoring as plain PySpark DataFrame functions."""
