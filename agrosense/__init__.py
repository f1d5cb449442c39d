"""agrosense — field sensor analytics on Spark (weather stations and soil probes).

Subpackages: ``sources`` (tables, files, message bus, test adapter), ``operators``
(parse, typed views, aggregates, ranking, trend, publish), ``functions`` (column
expressions), ``plans`` (daily and hourly results, suite, registered queries), ``sinks``
(append, replace, per-batch), ``streaming`` (raw archive and hourly jobs).
"""
