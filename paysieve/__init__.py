"""Payment-event pipeline and fraud analytics on PySpark DataFrames.

Landing JSON Lines -> bronze -> silver -> gold Parquet layers, a classifier
trained on and applied to gold, and serving tables written over JDBC.  Every
function takes and returns DataFrames and never creates a session.
"""

__version__ = "0.1.0"
