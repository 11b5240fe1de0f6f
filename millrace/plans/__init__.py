"""Jobs and registered queries assembled from the operators."""
