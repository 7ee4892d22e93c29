"""Result sinks: appended result tables, replaced tables, keyed tables."""
