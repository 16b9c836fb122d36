"""Cleaning, enrichment, routing and counting of mobile-game logs on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function, so the same code serves batch jobs and Structured Streaming.
"""
