"""Release-catalog operators for PySpark, and operators for training data in ``llm``."""
