"""tagloom: multi-tag labelling, training, scoring and evaluation on Spark DataFrames.

Subpackages:
  functions  column expressions (hashing, legacy text formats, vector math)
  sources    table readers, legacy text, SQLite and binary-file sources, sinks
  operators  tags, labels, sampling, scaling, training, scoring, metrics, summary
  plans      end-to-end jobs and the query catalogue
  streaming  incremental ingest of new track files
"""

__version__ = "0.1.0"
