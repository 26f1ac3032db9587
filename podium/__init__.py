"""Landing-to-gold lake jobs and their streaming twin, as plain Spark DataFrame code.

Layers, from the inside out:

``functions``   column expressions (text cleaning, number and date parsing)
``operators``   DataFrame -> DataFrame: clean, de-duplicate, join, average, messages, history
``sources``     CSV landing files, Parquet layers, JDBC tables, JSON topics
``sinks``       Parquet layers, JDBC tables, topics, per-batch fan-out
``streaming``   the parts that only exist on a stream: windows, starting a query
``plans``       complete jobs built from the layers above
``checks``      queries over the shared test tables and the SQL they must agree with
"""
