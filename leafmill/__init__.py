"""A PySpark engine for raw web documents."""
