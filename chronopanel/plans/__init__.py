"""Plans: canonical panels built from the input tables, composite reports
(Q01-Q10) and the catalogue of registered queries with their SQL oracles."""
