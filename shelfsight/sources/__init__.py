"""Readers: feed snapshots, stored tables, CSV backups and discovery."""
