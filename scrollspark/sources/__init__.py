"""Sources: files, folders, tables and downloads."""
