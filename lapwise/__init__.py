"""Race analytics on Spark: bronze, silver and gold tables, quality, monitoring and ML jobs.

Builders are plain ``DataFrame -> DataFrame`` functions; reading, writing and clocks stay at the edges.
"""
