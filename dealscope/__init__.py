"""dealscope: Spark-native deal-pipeline analytics.

Opportunity snapshots are cleaned and enriched into a mart, then summarised
into funnel, win-rate, cycle-time, attrition and stalled-deal tables; a
win-propensity model is fitted with Spark ML, open deals are scored, ranked
and explained, and data-quality checks run as Spark jobs.

Everything is a ``DataFrame -> DataFrame`` function so that Catalyst sees one
plan per query; no operator collects row-grain data to the driver.
"""

__version__ = "0.1.0"
