"""clickflow: commerce click-stream analytics as plain Spark DataFrame jobs.

Every public function takes DataFrames (plus explicit parameters such as
``as_of``) and returns a lazy DataFrame; only sinks trigger Spark actions.
"""

__version__ = "0.1.0"
