"""Patient-risk scoring, note retrieval and usage analytics as Spark jobs.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns); files appear only in ``sources`` and ``streaming``.
"""
