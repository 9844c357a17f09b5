"""Whole plans: metric tables, sinks, dashboard queries and the driver's queries."""
