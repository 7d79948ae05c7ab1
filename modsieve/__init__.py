"""modsieve: preparing, auditing and scoring labelled text on Spark."""
