"""Plans: the layered core/mart build, query catalog and oracle texts."""
