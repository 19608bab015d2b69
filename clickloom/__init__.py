"""Click-log feature preparation and click-through-rate modelling on Spark."""
