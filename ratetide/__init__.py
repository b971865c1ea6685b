"""ratetide: rate-change / property-transaction lag analytics as Spark jobs.

Every model is a function ``DataFrame(s) -> DataFrame``; nothing runs until
an action.  Sub-packages:

* ``sources``   landed-file readers (CSV / NDJSON / series) and test bindings
* ``functions`` column expressions (normalisation, dates, labels, fixed values)
* ``operators`` reusable relational operators (dedup, as-of, calendar lag, ...)
* ``plans``     the staging -> intermediate -> mart models and the pipeline runner
* ``sinks``     append / overwrite / merge-upsert / partitioned writers
* ``quality``   declarative data-quality checks and the write gate
* ``streaming`` Structured Streaming ingest of rate-change events
"""

__version__ = "0.1.0"
