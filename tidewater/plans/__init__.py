"""Run windows, bookmarks, table configs, composite jobs and the registered queries."""
