"""Sources: driver tables and adapters, files/sockets, generators, lookups."""
