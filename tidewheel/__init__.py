"""tidewheel: trip, zone-demand and risk analytics written as Spark DataFrame jobs."""
