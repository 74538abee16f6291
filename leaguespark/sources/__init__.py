"""Sources: pages with JSON in attributes, tables of pages, and texts of match sheets, read with built-in functions."""
