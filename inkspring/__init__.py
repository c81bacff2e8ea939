"""inkspring: chapter analytics and corpus preparation as PySpark jobs."""
