"""Jobs that write the lake: append, compaction, retention, backfill, audit, daily chain."""
