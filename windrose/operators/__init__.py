"""DataFrame -> DataFrame operators (relational, windowed, order dependent)."""
