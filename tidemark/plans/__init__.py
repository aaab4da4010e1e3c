"""Plans: composition of operators into the published tables, query registry, oracles."""
