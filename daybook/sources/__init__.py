"""Sources: transaction and price files, and adapters over the shared tables."""
