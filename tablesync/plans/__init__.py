"""Jobs with side effects: full load, sync, backfill, forecast; and the tables they publish."""
