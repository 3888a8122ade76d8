"""wayflux: a traffic lakehouse expressed as Spark DataFrame and Structured Streaming jobs.

Layers are plain tables.  Every operator is a function ``DataFrame -> DataFrame``; the batch and
the streaming jobs share the same transforms, and the traffic values (rules, bands, members) are
parameters with the defaults of :mod:`wayflux.domain`.
"""
