"""tessera: a PySpark-native engine for tiled rasters, ordered stacks and the tables around them."""
