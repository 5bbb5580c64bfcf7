"""Sources: tables, files, archives, pasted snippets, and corpora derived from the benchmark tables."""
