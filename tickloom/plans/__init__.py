"""Reports: staging, marts, dashboard panels, live views, checks and table upkeep."""
