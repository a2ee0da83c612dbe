"""Jobs: landed data and stored tables in, new table states and run reports out."""
