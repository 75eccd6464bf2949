"""Advertising-report analytics on Spark: lake and stream in, star schema and KPIs out."""
