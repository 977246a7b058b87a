"""Jobs: calendar, silver, gold, quality, lineage, migration, models."""
