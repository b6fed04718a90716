"""Sources: delimited text, JSON, stored HTML tables, generated calendar."""
