"""Mobile-advertising performance reporting as PySpark DataFrame plans."""
