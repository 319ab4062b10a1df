"""Clinical source records derived from the order tables, the registered queries over them, and their oracle SQL."""
