"""clinlake: a clinical-data lake engine expressed in PySpark DataFrames."""
