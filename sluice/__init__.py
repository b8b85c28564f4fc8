"""sluice: load sets of files into Spark tables and report on those loads.

Everything is expressed as DataFrame / writer / Structured Streaming
operations; there is no engine of our own.  Sub-packages:

* ``sources``   – path resolution, globbed listing, delimited-text parsing,
                  per-file script transforms
* ``operators`` – loading sinks (append / ignore / replace / per-file reload),
                  ledger versioning, progress windows
* ``functions`` – column-level helpers (file id, state machines, text)
* ``plans``     – the report plans (jobs, job, tasks, ps) and ledger views
* ``streaming`` – directory sync and lost-heartbeat detection as streams
"""

__version__ = "0.1.0"
