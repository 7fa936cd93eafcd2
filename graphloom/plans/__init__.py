"""Plans: lineage cuts, and the operators' queries over the driver's tables with their SQL twins."""
