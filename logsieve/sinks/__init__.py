"""Writers: messages, dead letters, the log table, the tools table."""
