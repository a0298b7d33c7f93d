"""Jobs: cleaned tables, marts, dashboard queries, name mapping, quality, run ledger."""
