"""kinfold: master data and entity resolution as Spark DataFrame jobs.

Every operator is a function from DataFrames (plus a validated spec) to
DataFrames.  Operators write nothing but stage tables in the session's shared
folder, which cut lineage; results leave through `sources` and `streaming`.
"""
