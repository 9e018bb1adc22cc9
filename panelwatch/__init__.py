"""Early-warning analytics over (week x spatial unit) panels, written as Spark DataFrame jobs."""
