"""HTML inside tasks: a small tree, and what pages are cleaned to and searched for."""
