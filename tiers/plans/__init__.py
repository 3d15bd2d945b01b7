"""Plans: table specs, layer builders, the layered run and the registered queries."""
