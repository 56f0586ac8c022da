"""Web-search analytics as Spark jobs: ranking comparison, crawl statistics, link
reach, inverted indexes, vector retrieval and prompt fan-out.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns); nothing is executed until the caller runs an action, except where a
docstring says that a table is written.
"""
