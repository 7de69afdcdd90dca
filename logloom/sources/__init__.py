"""Tables: a catalog of log tables, and how they are written."""
