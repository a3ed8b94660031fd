"""Sources: landed JSON, JSON over HTTP, JDBC tables, binary assets, hand-over JSON."""
