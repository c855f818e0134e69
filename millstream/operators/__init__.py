"""DataFrame operators. Every operator takes column names, so one operator serves any table."""
