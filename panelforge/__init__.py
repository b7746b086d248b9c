"""panelforge: monthly snapshot files to metric tables, on Spark DataFrames.

Every public function takes and returns DataFrames (or Columns). Nothing reads or
writes at import time and no session is created here.
"""
