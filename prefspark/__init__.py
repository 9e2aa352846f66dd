"""prefspark: preference-alignment data preparation and scoring as Spark DataFrame jobs.

Every public function takes DataFrames (and plain parameters) and returns a DataFrame;
nothing holds a hidden session, and the core path uses only built-in Spark SQL
expressions so Catalyst can prune, push down and code-generate the whole plan.
"""

__version__ = "0.1.0"
