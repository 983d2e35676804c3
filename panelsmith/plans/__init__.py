"""Plans: registered queries, the panel assembly and the imputation pipeline."""
