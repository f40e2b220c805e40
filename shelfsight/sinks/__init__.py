"""Writers: encoded columns, keyed tables, backups and the price log."""
